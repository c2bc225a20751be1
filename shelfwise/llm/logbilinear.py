"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Tokens are lower-cased (A-Z) runs of bytes other than blanks, then one end mark per text. Every token that occurs ``OWN`` times
and the square root of all training tokens over ``ROOT`` times, and the ``classes`` - 3 most frequent ones in any case, has
vectors of its own, as context and as target, so the vocabulary grows with the corpus. Any rarer token is "other", spelt out
by its smoothed count among the others, so the model is a distribution over all tokens, unseen ones included.

Model: the two tokens before predict a vector h = r[c1] C1 + r[c2] C2. The output has two levels of about the root of the
vocabulary each: first ``classes`` classes (other, the end mark, the most frequent tokens, and bins of tokens of like frequency),
scoring h.q[k] + b[k], then the members of a bin, scoring h.u[w] + c[w]. Normalisers are matrix products: of two tables for
pairs of the ``TABLE`` most frequent contexts, of h and u bin by bin. Distinct other pairs of a batch multiply a row of each context:
those of the ``HELD`` most frequent contexts are kept, that of a rarer one serves all its pairs; two rare ones take h and q.

Jobs: (1) token counts over all training texts, summed per task before the shuffle; (2) two passes of training: every
task walks its own texts from the shared parameters and each row of parameters is averaged by how often tasks met it (the first
pass takes an eighth of the texts, the second all of them); (3) scoring of all texts; tokens beyond the ``known`` most frequent
ones, whose counts every worker holds, find their counts by a join. The driver holds the model and the ``known`` counts,
both of a size set by parameters.

Defined results: a null text is empty and consists of its end mark; a null doc_id counts as the text ''; repeated rows
are scored and learnt each; with no training text the counts are zero and all tokens are unknown; token identity is a 64-bit
hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfwise.llm.shared import slices
from shelfwise.llm.words import NOT_SPACE, Words, buffers, lower_table, mix
from shelfwise.session import cut_lineage

CLASSES, DIM, KNOWN = 1024, 16, 1 << 18
NOISE, BATCH, RATE = 64, 1024, 0.2
START, END, OTHER = 0, 1, 2
END_HASH = np.uint64(0x656E64)
FLUSH = 1_000_000
OWN, ROOT, TABLE, HELD, PEERS = 16, 256, 2048, 8192, 4  # PEERS: noise members of a bin per target


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), held_out(F.col("doc_id")).alias("held_out"))


def _tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a batch with an end mark closing every text, and where each text begins."""
    words = Words(part.column("text"), NOT_SPACE, lower_table(), spans=False)
    counts = words.counts()
    begin = np.concatenate([[0], np.cumsum(counts + 1)])
    out = np.full(begin[-1], END_HASH, dtype=np.uint64)
    body = np.ones(begin[-1], dtype=bool)
    body[begin[1:] - 1] = False
    out[body] = words.hash
    return out, begin


def token_counts(training: DataFrame) -> DataFrame:
    """hash, n: how often each token occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sizes, held = [], [], 0

        def combined() -> pa.RecordBatch:
            values, at = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate(sizes), minlength=len(values)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["hash", "n"])

        for batch in batches:
            for part in slices(batch, "text"):
                values, n = np.unique(_tokens(part)[0], return_counts=True)
                keys.append(values)
                sizes.append(n)
                held += len(values)
                if held > FLUSH:
                    one = combined()
                    keys, sizes = [one.column(0).to_numpy().view(np.uint64)], [one.column(1).to_numpy()]
                    held = 0
                    if len(keys[0]) > FLUSH:
                        yield one
                        keys, sizes = [], []
        if keys:
            yield combined()

    partial = training.select("text").mapInArrow(count, "hash long, n long")
    return partial.groupBy("hash").agg(F.sum("n").alias("n"))


class Lookup:
    """Positions of 64-bit keys in a sorted list, found by their leading bits; -1 if absent."""

    BITS = 20

    def __init__(self, keys: np.ndarray):
        self.order = np.argsort(keys)
        self.keys = np.concatenate([keys[self.order], np.zeros(1, np.uint64)])
        prefix = (self.keys[:-1] >> np.uint64(64 - self.BITS)).astype(np.int64)
        self.begin = np.searchsorted(prefix, np.arange((1 << self.BITS) + 1))

    def __call__(self, values: np.ndarray) -> np.ndarray:
        prefix = (values >> np.uint64(64 - self.BITS)).astype(np.int64)
        at, stop = self.begin[prefix], self.begin[prefix + 1]
        out = np.full(len(values), -1, dtype=np.int64)
        left = np.flatnonzero(at < stop)
        while len(left):
            spot = at[left]
            same = self.keys[spot] == values[left]
            out[left[same]] = self.order[spot[same]]
            left = left[~same]
            at[left] += 1
            left = left[at[left] < stop[left]]
        return out


@dataclass
class Layout:
    """Vocabulary: start, end, other, ``heads`` tokens that are classes, then ``bins`` of ``width`` members each."""

    classes: int
    own: int
    heads: int
    bins: int
    width: int

    @property
    def cut(self) -> int:
        """First member of a bin."""
        return 3 + self.heads

    @property
    def size(self) -> int:
        return self.cut + self.bins * self.width

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.cut, ids, self.cut + (ids - self.cut) // self.width)

    def members(self) -> np.ndarray:
        """Tokens in each bin."""
        return np.clip(self.own - self.heads - np.arange(self.bins) * self.width, 0, self.width)


@dataclass
class Counts:
    """Most frequent tokens (descending) with their counts, and totals."""

    keys: np.ndarray
    n: np.ndarray
    total: int
    distinct: int
    classes: int

    def layout(self) -> Layout:
        """Tokens with vectors of their own and how they are dealt to classes."""
        least = max(OWN, self.total**0.5 / ROOT)
        own = max(min(len(self.keys), self.classes - 3), int((self.n >= least).sum()))
        bins = (self.classes - 3) // 2
        if own <= self.classes - 3 or not bins:
            return Layout(self.classes, min(own, self.classes - 3), self.classes - 3, 0, 1)
        heads = self.classes - 3 - bins
        return Layout(self.classes, own, heads, bins, -(-(own - heads) // bins))

    def id_of(self, known: np.ndarray) -> np.ndarray:
        """Vocabulary number of tokens given by their position in ``keys``."""
        table = np.full(len(self.keys) + 1, OTHER, dtype=np.int64)
        own = self.layout().own
        table[:own] = np.arange(3, 3 + own)
        table[:-1][self.keys == END_HASH] = END
        return table[known]

    def class_share(self) -> np.ndarray:
        """Share of each class among the training tokens, every class but the start having a little."""
        share = np.full(self.classes, 0.5)
        known = self.layout().class_of(self.id_of(np.arange(len(self.keys))))
        share += np.bincount(known, weights=self.n, minlength=self.classes)
        share[OTHER] += self.total - self.n.sum()
        share[START] = 0
        return share / share.sum()

    def member_logs(self) -> np.ndarray:
        """Logarithm of the share of each member in its bin (places that hold no token: next to nothing)."""
        at = self.layout()
        out = np.full(at.bins * at.width, -1e4)
        if at.bins:
            n = self.n[at.heads : at.own] + 0.5
            bins = np.arange(len(n)) // at.width
            out[: len(n)] = np.log(n / np.bincount(bins, weights=n)[bins])
        return out

    def others(self) -> tuple[int, int]:
        """Tokens and distinct tokens without a class of their own."""
        own = self.id_of(np.arange(len(self.keys))) != OTHER
        return int(self.total - self.n[own].sum()), int(self.distinct - own.sum())


def gather(counts: DataFrame, classes: int, known: int) -> Counts:
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the least count that no more than ``known`` tokens reach: from how many tokens have each count, not from a sort of all
    reached = F.sum("tokens").over(Window.orderBy(F.desc("n")))
    least = counts.groupBy("n").agg(F.count(F.lit(1)).alias("tokens")).withColumn("reached", reached).filter(F.col("reached") <= known).agg(F.min("n").alias("n"))
    # and every token that has vectors of its own
    own = max(OWN, (totals.n or 0) ** 0.5 / ROOT)
    top = counts.filter((F.col("n") >= least.scalar()) | (F.col("n") >= own)).toArrow()
    keys, n = top.column("hash").to_numpy().astype(np.int64), top.column("n").to_numpy().astype(np.int64)
    order = np.lexsort((keys, -n))
    return Counts(keys[order].view(np.uint64), n[order], totals.n, totals.v, classes)


class Model:
    """Parameters as rows of dim + 1: r (vocabulary), u with c (members), q with b (classes), C1, C2 (dim each)."""

    def __init__(self, flat: np.ndarray, layout: Layout, dim: int):
        self.flat, self.layout, self.dim = flat, layout, dim
        edges = np.cumsum([0, layout.size, layout.bins * layout.width, layout.classes, dim, dim])
        self.at_u, self.at_q = int(edges[1]), int(edges[2])
        self.r, u, q, c1, c2 = (flat[low:high] for low, high in zip(edges[:-1], edges[1:]))
        self.r, self.c1, self.c2 = self.r[:, :dim], c1[:, :dim], c2[:, :dim]
        self.u, self.c, self.q, self.b = u[:, :dim], u[:, dim], q[:, :dim], q[:, dim]

    @classmethod
    def fresh(cls, share: np.ndarray, dim: int, seed: int, layout: Layout | None = None, member_logs: np.ndarray | None = None) -> Model:
        classes = len(share)
        layout = layout or Layout(classes, classes - 3, classes - 3, 0, 1)
        rng = np.random.default_rng(seed)
        model = cls(np.zeros((layout.size + layout.bins * layout.width + classes + 2 * dim, dim + 1), np.float32), layout, dim)
        model.r[:] = rng.normal(0, 0.3, model.r.shape)
        model.r[layout.cut :] *= 0.2
        model.q[:], model.u[:] = rng.normal(0, 0.1, model.q.shape), rng.normal(0, 0.1, model.u.shape)
        model.c1[:], model.c2[:] = np.eye(dim), 0.5 * np.eye(dim)
        model.b[:] = np.log(np.maximum(share, 1e-12))
        if member_logs is not None:
            model.c[:] = member_logs
        return model

    def tables(self, contexts: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class scores given the token before and the one before that, and the log normaliser of each such pair, for the first contexts."""
        r = self.r[: self.layout.classes if contexts is None else contexts]
        one = (r @ self.c1 @ self.q.T).astype(np.float32)
        two = (r @ self.c2 @ self.q.T + self.b).astype(np.float32)
        two[:, START] = -1e4
        m1, m2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
        norm = np.exp(one - m1) @ np.exp(two - m2).T
        return one, two, np.log(np.maximum(norm, 1e-37)) + m1 + m2.T


def log_sums(h: np.ndarray, rows: np.ndarray, bias: np.ndarray, cells: int = 1 << 16) -> np.ndarray:
    """log sum over rows of exp(h.row + bias), for each h; ``cells`` scores at a time, so that they stay in a core's cache."""
    out = np.empty(len(h), dtype=np.float32)
    # where no score can overflow or all of a sum vanish, none need be scaled down before
    reach = np.sqrt(np.einsum("ij,ij->i", h, h).max(initial=0) * np.einsum("ij,ij->i", rows, rows).max(initial=0))
    h = np.hstack([h, np.ones((len(h), 1), np.float32)])
    turned = np.ascontiguousarray(np.hstack([rows, bias[:, None]]).T)
    plain = reach + np.abs(bias.max(initial=0)) < 60
    one = np.ones(len(rows), np.float32)
    step = max(1, cells // max(1, len(rows)))
    held = np.empty((min(step, len(h)), len(rows)), np.float32)
    for low in range(0, len(h), step):
        part = h[low : low + step]
        x = np.matmul(part, turned, out=held[: len(part)])
        if plain:
            np.exp(x, out=x)
            out[low : low + step] = np.log(x @ one)
        else:
            most = x.max(axis=1, keepdims=True)
            x -= most
            np.exp(x, out=x)
            out[low : low + step] = np.log(x @ one) + most[:, 0]
    return out


class Scorer:
    """Log probabilities of vocabulary numbers after two others, all levels taken together."""

    def __init__(self, model: Model, table: int = TABLE, held: int = HELD):
        self.model, self.layout = model, model.layout
        self.table = min(table, model.layout.size)
        self.norm = model.tables(self.table)[2]
        self.one, self.two = model.r @ model.c1, model.r @ model.c2
        self.q, self.b = np.ascontiguousarray(model.q), model.b.copy()
        self.b[START] = -1e4
        self.held = min(held, model.layout.size)
        (self.exp1, self.most1), (self.exp2, self.most2) = self.rows(self.one[: self.held]), self.rows(self.two[: self.held], self.b)

    def rows(self, vectors: np.ndarray, bias: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """exp of the class scores of each context less their largest, and the largest."""
        scores = vectors @ self.q.T
        if bias is not None:
            scores += bias
        most = scores.max(axis=1)
        scores -= most[:, None]
        return np.exp(scores, out=scores), most

    def pair_sums(self, p: np.ndarray, q: np.ndarray, step: int = 64) -> np.ndarray:
        """Log normalisers of pairs of contexts: exp(a + b) is exp(a) exp(b), and the rows of exp(a) and exp(b) serve several pairs."""
        out, sure = np.empty(len(p), dtype=np.float32), np.zeros(len(p), dtype=bool)

        def put(at: np.ndarray, exp1: np.ndarray, i: np.ndarray, exp2: np.ndarray, j: np.ndarray, most: np.ndarray) -> None:
            for low in range(0, len(at), step):
                some = slice(low, low + step)
                total = np.vecdot(exp1.take(i[some], axis=0), exp2.take(j[some], axis=0))
                sure[at[some]] = total > 1e-30  # else nearly all of the sum may have vanished
                out[at[some]] = np.log(np.maximum(total, 1e-37)) + most[some]

        first, second = p < self.held, q < self.held
        at = np.flatnonzero(first & second)
        i, j = p.take(at), q.take(at)
        put(at, self.exp1, i, self.exp2, j, self.most1.take(i) + self.most2.take(j))
        # pairs of a held context and another, in the order of that other one: its row is made once
        for rare, held, vectors, bias, at in ((p, q, self.one, None, np.flatnonzero(~first & second)), (q, p, self.two, self.b, np.flatnonzero(first & ~second))):
            at = at.take(np.argsort(rare.take(at), kind="stable"))
            begin = np.flatnonzero(np.diff(rare.take(at), prepend=-1))
            place = np.repeat(np.arange(len(begin)), np.diff(begin, append=len(at)))
            edges = np.append(begin, len(at))
            for low in range(0, len(begin), step):
                some = slice(edges[low], edges[min(low + step, len(begin))])
                exp, most = self.rows(vectors.take(rare.take(at.take(begin[low : low + step])), axis=0), bias)
                i, j = place[some] - low, held.take(at[some])
                if rare is p:
                    put(at[some], exp, i, self.exp2, j, most.take(i) + self.most2.take(j))
                else:
                    put(at[some], self.exp1, j, exp, i, most.take(i) + self.most1.take(j))
        rest = np.flatnonzero(~sure)
        h = self.one.take(p.take(rest), axis=0)
        h += self.two.take(q.take(rest), axis=0)
        out[rest] = log_sums(h, self.q, self.b)
        return out

    def __call__(self, ids: np.ndarray, c1: np.ndarray, c2: np.ndarray, step: int = 1 << 15) -> np.ndarray:
        at = self.layout
        h = self.one.take(c1, axis=0)
        k = at.class_of(ids)
        out = self.b.take(k)
        for low in range(0, len(ids), step):
            some = slice(low, low + step)
            h[some] += self.two.take(c2[some], axis=0)
            out[some] += np.einsum("ij,ij->i", h[some], self.q.take(k[some], axis=0))
        near = (c1 < self.table) & (c2 < self.table)
        close, far = np.flatnonzero(near), np.flatnonzero(~near)
        out[close] -= self.norm.take(c1.take(close) * self.table + c2.take(close))
        if len(far):
            pairs, back = np.unique(c1.take(far) * at.size + c2.take(far), return_inverse=True)
            out[far] -= self.pair_sums(pairs // at.size, pairs % at.size)[back]
        tail = np.flatnonzero(ids >= at.cut)
        if len(tail):
            u, c = self.model.u, self.model.c
            bins = (ids.take(tail) - at.cut) // at.width
            order = np.argsort(bins.astype(np.min_scalar_type(at.bins)), kind="stable")
            edges = np.cumsum(np.append(0, np.bincount(bins, minlength=at.bins)))
            tail = tail.take(order)
            own, h = ids.take(tail) - at.cut, h.take(tail, axis=0)
            logs = c.take(own)
            for bin_ in np.flatnonzero(np.diff(edges)):
                some, rows = slice(edges[bin_], edges[bin_ + 1]), slice(bin_ * at.width, (bin_ + 1) * at.width)
                logs[some] += np.einsum("ij,ij->i", h[some], u[own[some]])
                logs[some] -= log_sums(h[some], u[rows], c[rows])
            out[tail] += logs
        return out


def contexts(classes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Classes one and two places before each token of its text; the start class before the text."""
    one, two = np.empty_like(classes), np.empty_like(classes)
    one[1:], two[2:] = classes[:-1], classes[:-2]
    first = begin[:-1]
    one[first] = two[first] = START
    second = first[np.diff(begin) > 1] + 1
    two[second] = START
    return one, two


def train(model: Model, share: np.ndarray, streams: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], seed: int, noise: int = NOISE, batch: int = BATCH, rate: float = RATE) -> tuple[int, np.ndarray]:
    """Noise-contrastive steps (Adagrad) in place over (target, before, before that); gives the tokens seen and how often each row was met."""
    rng = np.random.default_rng(seed)
    pool = rng.choice(len(share), size=1 << 16, p=share)
    prior = np.log(noise * np.maximum(share, 1e-12)).astype(np.float32)
    at, dim = model.layout, model.dim
    # parameters and the sums of their squared steps: a row is fetched and put back once a batch, as one value, without a loop over its numbers
    wide = dim + 1
    state, squares = model.flat.astype(np.float32), np.full(model.flat.shape, 1e-2, dtype=np.float32)
    squares[at.cut : model.at_q] = 1e-5  # a rare token has few steps
    row = np.dtype((np.void, 4 * wide))
    state_rows, squares_rows = state.view(row)[:, 0], squares.view(row)[:, 0]
    met = np.zeros(len(state), dtype=np.int64)
    members, place = at.members(), np.zeros(len(state), dtype=np.int32)
    even = np.log(PEERS / np.maximum(members, 1)).astype(np.float32)
    at_c = model.at_q + at.classes
    cells, spots = np.arange(wide), np.arange(max(2, PEERS + 1) * batch + noise, dtype=np.int32)
    seen = 0

    def fetch(rows: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Parameters of each place in ``rows``; the distinct rows, each at its last place, with what ``spread`` needs."""
        place[rows] = spots[: len(rows)]
        back = place.take(rows)
        last = back == spots[: len(rows)]
        first, again = np.flatnonzero(last), np.flatnonzero(~last)
        to = (np.cumsum(last, dtype=np.int32) - 1).take(back)
        rows = rows.take(first)
        held = state.take(rows, axis=0)
        return held.take(to, axis=0), (rows, first, again, to, held)

    def move(held: np.ndarray, sums: np.ndarray, step: np.ndarray) -> None:
        sums += step * step
        step *= np.float32(rate)
        step /= np.sqrt(sums)
        held += step

    def spread(found: tuple, steps: np.ndarray, n: int) -> None:
        """One step for each distinct row: that of its last place, to which those of its other places are added."""
        rows, first, again, to, held = found
        total = steps.take(first, axis=0)
        if len(again):
            at_cell = (to.take(again)[:, None] * wide + cells).ravel()
            total += np.bincount(at_cell, weights=steps.take(again, axis=0).ravel(), minlength=total.size).reshape(total.shape)
        total *= np.float32(1 / n)
        sums = squares.take(rows, axis=0)
        move(held, sums, total)
        state_rows[rows], squares_rows[rows] = held.view(row)[:, 0], sums.view(row)[:, 0]

    mixers = state[at_c:]  # C1 and C2
    for targets, ones, twos in streams:
        drawn = []
        for low in range(0, len(targets), batch):
            t, c1, c2 = targets[low : low + batch], ones[low : low + batch], twos[low : low + batch]
            n = len(t)
            k = at.class_of(t)
            s = pool[rng.integers(0, len(pool), noise)]
            # vectors have their bias as one more place, for which a predicted vector holds 1
            r, contexts_found = fetch(np.concatenate([c1, c2]))
            r1, r2 = r[:n, :dim], r[n:, :dim]
            m1, m2 = mixers[:dim, :dim], mixers[dim:, :dim]
            h = np.ones((n, wide), np.float32)
            h[:, :dim] = r1 @ m1 + r2 @ m2
            rows = np.concatenate([k, s])
            q, classes_found = fetch(rows + model.at_q)
            drawn.append(s + model.at_q)
            biased = q.copy()
            biased[:, dim] -= prior.take(rows)
            up = 1 / (1 + np.exp(np.clip(np.einsum("ij,ij->i", h, biased[:n]), -30, 30)))
            down = h @ biased[n:].T
            np.clip(down, -30, 30, out=down)
            np.negative(down, out=down)
            np.exp(down, out=down)
            down += 1
            np.divide(-1, down, out=down)
            back = down @ q[n:, :dim]
            back += up[:, None] * q[:n, :dim]
            spread(classes_found, np.concatenate([up[:, None] * h, down.T @ h]), n)
            tail = np.flatnonzero(t >= at.cut)
            if len(tail):
                own, ht = t[tail] - at.cut, h.take(tail, axis=0)
                bins = own // at.width
                peers = bins[:, None] * at.width + (rng.random((len(tail), PEERS)) * members[bins][:, None]).astype(np.int64)
                u, members_found = fetch(np.concatenate([own[:, None], peers], axis=1).ravel() + model.at_u)
                drawn.append(peers.ravel() + model.at_u)
                u = u.reshape(len(tail), PEERS + 1, wide)  # a target and its peers
                pull = np.einsum("ij,ikj->ik", ht, u)
                pull -= even.take(bins)[:, None]
                np.clip(pull, -30, 30, out=pull)
                pull[:, 1:] *= -1
                np.exp(pull, out=pull)
                pull += 1
                np.divide(1, pull, out=pull)
                pull[:, 1:] *= -1
                back[tail] += np.einsum("ik,ikj->ij", pull, u)[:, :dim]
                steps = np.repeat(ht, PEERS + 1, axis=0)
                steps *= pull.reshape(-1, 1)
                spread(members_found, steps, n)
            turn, ahead = np.zeros((2 * dim, wide), np.float32), np.zeros((2 * n, wide), np.float32)
            turn[:dim, :dim], turn[dim:, :dim] = r1.T @ back, r2.T @ back
            ahead[:n, :dim], ahead[n:, :dim] = back @ m1.T, back @ m2.T
            spread(contexts_found, ahead, n)
            turn *= np.float32(1 / n)
            move(mixers, squares[at_c:], turn)
            seen += n
        near, far = at.class_of(targets) + model.at_q, targets[targets >= at.cut] - at.cut + model.at_u
        for rows in (ones, twos, near, far, *([np.concatenate(drawn)] if drawn else [])):
            met += np.bincount(rows, minlength=len(met))
    model.flat[:] = state
    met[at_c:] = seen
    return seen, met


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Mean of the rows with one number, weighted by how often each was met."""
    at, met, values, held = [], [], [], 0

    def combined() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows, place = np.unique(np.concatenate(at), return_inverse=True)
        order = np.argsort(place, kind="stable")
        edge = np.searchsorted(place[order], np.arange(len(rows)))
        return rows, np.add.reduceat(np.concatenate(met)[order], edge), np.add.reduceat(np.concatenate(values)[order], edge, axis=0)

    for batch in batches:
        if batch.num_rows:
            n = batch.column("met").to_numpy()
            at.append(batch.column("at").to_numpy())
            met.append(n)
            values.append(unpacked(batch.column("value")).astype(np.float64) * n[:, None])
            held += len(n)
            if held > FLUSH // 8:
                at, met, values = ([x] for x in combined())
                held = 0
    if at:
        rows, n, total = combined()
        yield packed(rows, n, (total / n[:, None]).astype(np.float32))


def packed(at: np.ndarray, met: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    cuts = np.arange(len(values) + 1, dtype=np.int32) * np.int32(4 * values.shape[1])
    value = pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(values, np.float32))])
    return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(met), value], ["at", "met", "value"])


def unpacked(value: pa.Array) -> np.ndarray:
    return buffers(value)[0].view(np.float32).reshape(len(value), -1)


def averaged(training: DataFrame, counts, flat: np.ndarray, dim: int, seed: int) -> np.ndarray:
    """One pass: every task trains from ``flat`` on its texts; each row averaged by how often tasks met it."""
    context = training.sparkSession.sparkContext
    shared = context.broadcast(flat)
    form = "at int, met long, value binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Counts = counts.value
        find, share, layout = Lookup(known.keys), known.class_share(), known.layout()
        numbers = known.id_of(np.arange(-1, len(known.keys)))
        model = Model(shared.value.copy(), layout, dim)
        part_id = TaskContext.get().partitionId()

        def streams():
            for batch in batches:
                for part in slices(batch, "text"):
                    values, begin = _tokens(part)
                    ids = numbers[find(values) + 1]
                    one, two = contexts(ids, begin)
                    mixed = np.argsort(mix(np.arange(len(ids), dtype=np.uint64)))
                    yield ids[mixed], one[mixed], two[mixed]

        _, met = train(model, share, streams(), seed + part_id)
        rows = np.flatnonzero(met)
        for low in range(0, len(rows), 1 << 16):
            some = rows[low : low + (1 << 16)]
            yield packed(some, met[some], model.flat[some])

    parts = training.select("text").mapInArrow(run, form)
    mean = parts.repartition("at").mapInArrow(summed, form).toArrow()
    out = flat.copy()
    if mean.num_rows:
        for batch in mean.to_batches():
            if batch.num_rows:
                out[batch.column("at").to_numpy()] = unpacked(batch.column("value"))
    return out


def fit(training: DataFrame, counts: Counts, dim: int = DIM, seed: int = 1) -> np.ndarray:
    shared = training.sparkSession.sparkContext.broadcast(counts)
    flat = Model.fresh(counts.class_share(), dim, seed, counts.layout(), counts.member_logs()).flat
    eighth = training.filter(F.pmod(F.xxhash64("text"), F.lit(8)) == 0)
    for rows in (eighth, training):
        flat = averaged(rows, shared, flat, dim, seed)
    return flat


SCORED = (
    "rid long, doc_id {id}, held_out boolean, n_tokens long, n_known long, count_logs double, other_logs double, n_other long,"
    " class_logs double, rare array<struct<hash:long,n:int>>"
)


def score(docs: DataFrame, classes: int = CLASSES, dim: int = DIM, known: int = KNOWN, seed: int = 1) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document (log10)."""
    rows = texts(docs)
    training = rows.filter(~F.col("held_out"))
    counts = cut_lineage(token_counts(training))
    top = gather(counts, classes, known)
    flat = fit(training, top, dim, seed)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((top, flat))
    rare_type = pa.list_(pa.struct([("hash", pa.int64()), ("n", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, params = shared.value
        find = Lookup(counted.keys)
        prob_of = Scorer(Model(params, counted.layout(), dim))
        numbers = counted.id_of(np.arange(-1, len(counted.keys)))
        logs = np.log10(np.append(counted.n, 0) + 0.5)
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text"):
                values, begin = _tokens(part)
                at = find(values)
                ids = numbers[at + 1]
                c1, c2 = contexts(ids, begin)
                prob = prob_of(ids, c1, c2).astype(np.float64) / np.log(10)
                known_log = np.where(at >= 0, logs[at], 0.0)
                per = lambda x: np.add.reduceat(x, begin[:-1])
                n = part.num_rows
                row = np.repeat(np.arange(n), np.diff(begin))
                far = at < 0
                hashed, rare_row = values[far], row[far]
                order = np.lexsort((hashed, rare_row))
                hashed, rare_row = hashed[order], rare_row[order]
                new = np.ones(len(hashed), dtype=bool)
                new[1:] = (hashed[1:] != hashed[:-1]) | (rare_row[1:] != rare_row[:-1])
                first = np.flatnonzero(new)
                sizes = np.diff(np.append(first, len(hashed))).astype(np.int32)
                entries = pa.StructArray.from_arrays([pa.array(hashed[first].view(np.int64)), pa.array(sizes)], ["hash", "n"])
                offsets = np.searchsorted(rare_row[first], np.arange(n + 1)).astype(np.int32)
                rare = pa.ListArray.from_arrays(pa.array(offsets), entries).cast(rare_type)
                other = ids == OTHER
                columns = [
                    pa.array(np.arange(n) + rid), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(begin)),
                    pa.array(per((at >= 0).astype(np.int64))), pa.array(per(known_log)), pa.array(per(np.where(other, known_log, 0.0))),
                    pa.array(per(other.astype(np.int64))), pa.array(per(prob)), rare,
                ]
                rid += n
                yield pa.RecordBatch.from_arrays(columns, ["rid", "doc_id", "held_out", "n_tokens", "n_known", "count_logs", "other_logs", "n_other", "class_logs", "rare"])

    scored = cut_lineage(rows.mapInArrow(run, SCORED.format(id=rows.schema["doc_id"].dataType.simpleString())))
    looked = scored.select("rid", F.inline("rare")).join(counts.withColumnRenamed("n", "c"), "hash", "left")
    found = looked.groupBy("rid").agg(
        F.sum(F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_logs"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
    )
    n_others, v_others = top.others()
    base = float(np.log10(top.total + 0.5 * (top.distinct + 1)))
    spelt = float(np.log10(n_others + 0.5 * (v_others + 1)))
    rare_logs = F.coalesce("rare_logs", F.lit(0.0))
    return scored.drop("rare").join(found, "rid", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(top.total).cast("long").alias("train_tokens"),
        (F.col("count_logs") + rare_logs - F.col("n_tokens") * base).alias("base_score"),
        (F.col("class_logs") + F.col("other_logs") + rare_logs - F.col("n_other") * spelt).alias("score"),
    )
