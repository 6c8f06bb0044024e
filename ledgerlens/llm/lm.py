"""Language-model scoring with a weighted backoff automaton.

The model is over the bytes of UTF-8, with a start context and an end symbol: n-grams up to ``ORDER`` of all
documents are counted and smoothed by interpolated absolute discounting.  Every context is a state.  A seen n-gram
is an arc with its interpolated probability; a failure arc leads to the context without its oldest symbol and
costs the mass that discounting set aside, so that following failures gives unseen n-grams exactly their
interpolated probability.  Bytes bound the alphabet, so any text in any script has a finite score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MAX_BROADCAST_BYTES, ids, offsets, prepare, slices, stored

ORDER, DISCOUNT = 5, 0.75
BITS, END, SYMBOLS = 9, 257, 257  # symbols: 0 pads before a text, 1 to 256 bytes, 257 its end; 257 can be predicted
SEGMENT = 512
ARC_BYTES = 40  # of an arc in a worker
GROUP_BYTES = 32 << 20  # of texts read by an automaton of their own


def _mask(k: int) -> int:
    return (1 << BITS * k) - 1


def symbols(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, begin, end): each text is order - 1 zeros, its bytes + 1 and END; begin and end without the zeros."""
    texts = pc.fill_null(texts, "")
    off = offsets(texts)
    n, pad = np.diff(off), order - 1
    begin = np.cumsum(n + pad + 1) - n - 1
    out = np.zeros(int((n + pad + 1).sum()), np.int64)
    if len(n) and off[-1] > off[0]:
        at = np.arange(off[-1] - off[0]) + np.repeat(begin - off[:-1] + off[0], n)
        out[at] = np.frombuffer(texts.buffers()[2], np.uint8)[off[0] : off[-1]].astype(np.int64) + 1
    out[begin + n] = END
    return out, begin, begin + n + 1


def ngrams(s: np.ndarray, order: int) -> np.ndarray:
    """Codes of the n-grams that end at each symbol that is predicted; the newest symbol is in the lowest bits."""
    code = s.copy()
    for j in range(1, order):
        code[j:] |= s[:-j] << (BITS * j)
    return code[s > 0]


def _count(order: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> None:
            code, back = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            held[:] = [(code, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64))]

        for b in slices(batches, most=4 << 20):
            held.append(np.unique(ngrams(symbols(b.column(0), order)[0], order), return_counts=True))
            if len(held) > 8:
                merge()
        if held:
            merge()
            code, n = held[0]
            for i in range(0, len(code), 1 << 17):
                yield pa.RecordBatch.from_arrays([pa.array(code[i : i + (1 << 17)]), pa.array(n[i : i + (1 << 17)])], ["code", "n"])
    return run


def estimate(docs: DataFrame, text: str = "text", order: int = ORDER, discount: float = DISCOUNT) -> tuple[DataFrame, DataFrame]:
    """The model as two tables: arcs (k, code, logp) and failures (k, context, logw), for orders k from 1 to ``order``.

    Counts are of all texts; each partition combines its own before anything is shuffled.  Null texts don't count.
    """
    prepare(docs.sparkSession)
    counts = stored(docs.select(F.col(text).alias("text")).where("text is not null").mapInArrow(_count(order), "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))
    lower, arcs, failures = None, [], []
    for k in range(1, order + 1):
        seen = counts.groupBy(F.col("code").bitwiseAND(_mask(k)).alias("code")).agg(F.sum("n").cast("double").alias("n")) if k < order else counts.select("code", F.col("n").cast("double").alias("n"))
        seen = seen.withColumn("context", F.shiftright("code", BITS))
        context = seen.groupBy("context").agg(F.sum("n").alias("total"), F.count("*").alias("types")).withColumn("w", discount * F.col("types") / F.col("total"))
        p = (F.col("n") - discount) / F.col("total")
        if lower is None:
            now = seen.join(F.broadcast(context), "context").select("code", (p + F.col("w") / SYMBOLS).alias("p"))
        else:
            now = (seen.join(context, "context").withColumn("shorter", F.col("code").bitwiseAND(_mask(k - 1)))
                   .join(lower.select(F.col("code").alias("shorter"), F.col("p").alias("q")), "shorter").select("code", (p + F.col("w") * F.col("q")).alias("p")))
        lower = stored(now)
        arcs.append(lower.select(F.lit(k).alias("k"), "code", F.ln("p").alias("logp")))
        failures.append(context.select(F.lit(k).alias("k"), "context", F.ln("w").alias("logw")))
    union = lambda parts: parts[0] if len(parts) == 1 else union([parts[0].unionByName(parts[1]), *parts[2:]])
    return union(arcs), stored(union(failures))


class Automaton:
    """States and arcs as arrays; arcs are found by (state, symbol) in an open-addressing table."""

    def __init__(self, k: np.ndarray, code: np.ndarray, logp: np.ndarray, fk: np.ndarray, context: np.ndarray, logw: np.ndarray, order: int):
        self.order = order
        order_ = np.lexsort((context, fk))  # states: the root first, then by length
        fk, context, self.logw = fk[order_], context[order_], logw[order_]
        span = [np.searchsorted(fk, [j, j + 1]) for j in range(1, order + 2)]

        def state(length: np.ndarray, c: np.ndarray) -> np.ndarray:
            """The longest suffix, of at most that length, that is a state."""
            out = np.full(len(c), -1, np.int64)
            for n in range(order - 1, -1, -1):
                lo, hi = span[n]
                todo = np.flatnonzero((out < 0) & (length >= n))
                want = c[todo] & _mask(n)
                at = np.minimum(lo + np.searchsorted(context[lo:hi], want), max(lo, hi - 1))
                ok = (context[at] == want) if hi > lo else np.zeros(len(todo), bool)
                out[todo[ok]] = at[ok]
            return out

        length = fk - 1
        self.fail = np.zeros(len(fk), np.int64)
        self.fail[1:] = state(length[1:] - 1, context[1:])
        self.start = int(state(np.array([order - 1]), np.array([0]))[0])
        source = state(k - 1, code >> BITS)
        target = np.where(code & _mask(1) == END, 0, state(np.minimum(k, order - 1), code))
        key = (source << BITS) | (code & _mask(1))
        root = np.setdiff1d(np.arange(1, SYMBOLS + 1), key[source == 0])  # the root has an arc for every symbol
        key = np.append(key, root)
        self.logp = np.append(logp, np.full(len(root), self.logw[0] - np.log(SYMBOLS)))
        self.next = np.append(target, np.zeros(len(root), np.int64))
        self.bits = max(4, int(2.5 * len(key)).bit_length())
        self.key, self.arc = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        todo, slot = np.arange(len(key)), self._slot(key)
        while len(todo):
            free = self.key[slot] < 0
            self.key[slot[free]] = key[todo[free]]  # of several the last one wins
            won = self.key[slot] == key[todo]
            self.arc[slot[won]] = todo[won]
            todo, slot = todo[~won], (slot[~won] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def find(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The arc of each (state, symbol), -1 where there is none."""
        key = (state << BITS) | symbol
        slot = self._slot(key)
        got = self.key[slot]
        arc = self.arc[slot].astype(np.int64)
        arc[got < 0] = -1
        off = np.flatnonzero((got != key) & (got >= 0))
        while len(off):
            slot[off] = (slot[off] + 1) & (len(self.key) - 1)
            got = self.key[slot[off]]
            arc[off] = np.where(got == key[off], self.arc[slot[off]], -1)
            off = off[(got != key[off]) & (got >= 0)]
        return arc

    def read(self, s: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Log-probability of s[begin:end] for each text, which order - 1 zeros precede.

        Texts are read left to right in segments side by side.  A state is determined by the last order - 1
        symbols, so a segment starts in the state that reading those before it from the root leads to.
        """
        pieces = np.maximum(1, -(-(end - begin) // SEGMENT))
        text = np.repeat(np.arange(len(begin)), pieces)
        at = begin[text] + (np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * SEGMENT
        stop = np.minimum(at + SEGMENT, end[text])
        by = np.argsort(at - stop, kind="stable")  # the longest first: those still being read are a prefix
        text, at, stop = text[by], at[by], stop[by]
        state = np.where(at == begin[text], self.start, 0)
        total = np.zeros(len(at))
        for t in range(1 - self.order, int((stop - at).max()) if len(at) else 0):
            live = np.arange(len(at)) if t < 0 else slice(0, int(np.searchsorted(at - stop, -t, "left")))
            if t < 0:
                live = live[at > begin[text]]
                if not len(live):
                    continue
            now, symbol = state[live], s[at[live] + t]
            if t < 0:
                known = symbol > 0
                symbol = np.where(known, symbol, 1)
            arc = self.find(now, symbol)
            add = np.zeros(len(arc))
            miss = np.flatnonzero(arc < 0)
            while len(miss):
                add[miss] += self.logw[now[miss]]
                now[miss] = self.fail[now[miss]]
                arc[miss] = self.find(now[miss], symbol[miss])
                miss = miss[arc[miss] < 0]
            if t < 0:
                state[live] = np.where(known, self.next[arc], self.start)
            else:
                state[live] = self.next[arc]
                total[live] += add + self.logp[arc]
        return np.bincount(text, total, minlength=len(begin))


def _read(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = shared.value
        for b in slices(batches, most=4 << 20):
            s, begin, end = symbols(b.column(1), a.order)
            got = a.read(s, begin, end)
            null = b.column(1).is_null().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(end - begin - 1, mask=null), pa.array(got, mask=null)], ["doc_id", "bytes", "logp"])
    return run


def _grouped(most: int):
    """(doc_id, text, grp): texts of a partition in groups of about ``most`` bytes, in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for b in batches:
            if not b.num_rows:
                continue
            end = held + np.cumsum(np.diff(offsets(b.column(1))))
            group = (b.column(2).to_numpy().astype(np.int64) << 32) | (np.append(held, end[:-1]) // most)
            held = int(end[-1])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(group)], ["doc_id", "text", "grp"])
    return run


def _met(order: int):
    """(grp, code): the n-grams of a group's texts, each once a run of rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(held), group)), pa.array(held)], ["grp", "code"])
        for b in slices(batches, "text", 4 << 20):
            own = b.column(0).to_numpy()
            cut = np.concatenate([[0], np.flatnonzero(own[1:] != own[:-1]) + 1, [len(own)]])
            for i, j in zip(cut.tolist(), cut[1:].tolist()):
                if own[i] != group and len(held):
                    yield out()
                    held = held[:0]
                group = own[i]
                held = np.union1d(held, ngrams(symbols(b.column(1).slice(i, j - i), order)[0], order))
        if len(held):
            yield out()
    return run


def by_groups(d: DataFrame, arcs: DataFrame, failures: DataFrame, order: int, most: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, bytes, logp) by one automaton for each group of texts, of the states and arcs that these texts meet.

    A group's n-grams, each once, meet the model's tables; its automaton then reads its texts as the whole one would:
    every context that precedes a symbol of the texts is a state of it, with all shorter ones.
    """
    rows = stored(d.where("text is not null").withColumn("pid", F.spark_partition_id()).mapInArrow(_grouped(most), "doc_id long, text string, grp long"))
    met = stored(rows.select("grp", "text").mapInArrow(_met(order), "grp long, code long").distinct())
    parts = []
    for k in range(1, order + 1):
        code = met.select("grp", F.col("code").bitwiseAND(_mask(k)).alias("code")).distinct() if k < order else met
        parts.append(code.join(arcs.where(F.col("k") == k).select("code", "logp"), "code").select("grp", F.lit(True).alias("arc"), F.lit(k).alias("k"), "code", "logp"))
        context = code.select("grp", F.shiftright("code", BITS).alias("code")).distinct()
        parts.append(context.join(failures.where(F.col("k") == k).select(F.col("context").alias("code"), F.col("logw").alias("logp")), "code").select("grp", F.lit(False).alias("arc"), F.lit(k).alias("k"), "code", "logp"))
    model = parts[0]
    for p in parts[1:]:
        model = model.unionByName(p)

    def read(texts: pa.Table, held: pa.Table) -> pa.Table:
        arc = held["arc"].to_numpy()
        k, code, logp = (held[c].to_numpy() for c in ("k", "code", "logp"))
        a = Automaton(k[arc].astype(np.int64), code[arc], logp[arc], k[~arc].astype(np.int64), code[~arc], logp[~arc], order)
        got = [(np.zeros(0, np.int64), np.zeros(0))]
        for b in slices(iter(texts.select(["text"]).combine_chunks().to_batches()), "text", 4 << 20):
            s, begin, end = symbols(b.column(0), order)
            got.append((end - begin - 1, a.read(s, begin, end)))
        n, logp = (np.concatenate(c) for c in zip(*got))
        return pa.table({"doc_id": texts["doc_id"], "bytes": pa.array(n), "logp": pa.array(logp)})
    return rows.groupBy("grp").cogroup(stored(model).groupBy("grp")).applyInArrow(read, "doc_id long, bytes long, logp double")


def compiled(arcs: DataFrame, failures: DataFrame, order: int = ORDER) -> Automaton:
    a, f = arcs.toArrow(), failures.toArrow()
    return Automaton(*(a[c].to_numpy() for c in ("k", "code", "logp")), *(f[c].to_numpy() for c in ("k", "context", "logw")), order)


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER, discount: float = DISCOUNT, most_bytes: int = MAX_BROADCAST_BYTES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(doc_id, bytes, logp, bits_per_byte) for each row, by the model of all texts of ``docs``.

    logp is natural and includes the end symbol; bits_per_byte is per symbol read, the end included.  An empty
    text is just its end; a null text has null scores.  Repeated rows are scored each, and count each; rows
    without an id count but get no score; an empty table gives an empty one; other columns are never read.  The
    automaton goes to the workers if its counted arcs fit ``most_bytes``; beyond, each group of texts gets the part of
    it that its texts meet, and is read in the same way.
    """
    arcs, failures = estimate(docs, text, order, discount)
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    n = arcs.count()
    if not n:
        scored = d.select("doc_id", F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("double").alias("logp"))
    elif n * ARC_BYTES <= most_bytes:
        shared = docs.sparkSession.sparkContext.broadcast(compiled(arcs, failures, order))
        scored = d.mapInArrow(_read(shared), "doc_id long, bytes long, logp double")
    else:
        none = d.where("text is null").select("doc_id", F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("double").alias("logp"))
        scored = by_groups(d, arcs, failures, order, group_bytes).unionByName(none)
    return scored.select("doc_id", "bytes", F.round("logp", 6).alias("logp"), F.round(-F.col("logp") / (F.col("bytes") + 1) / np.log(2.0), 6).alias("bits_per_byte"))
