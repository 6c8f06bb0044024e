"""Toxicity by nearest labelled examples.

Fitting: at most ``max_labelled`` labelled rows (those of the smallest id hashes) give the vocabulary and the
calibration; the examples are all labelled texts.  Of texts with the same terms as often only the ``k`` + 1 of the
smallest ids are held, as no other can be among the nearest.  The vocabulary is the terms whose presence tells the label: an odds ratio of at least ``min_odds`` in either direction,
a likelihood-ratio statistic of at least ``min_g2`` and presence in at least ``min_support`` of the rarer class.  Document frequencies are those of all documents.
Terms outside it count for nothing and vectors are of unit length over what is left, so cosines aren't those of the
documents' whole TF-IDF vectors, and a text without a term of the vocabulary has no neighbours (README has figures).
Scoring: each document's TF-IDF vector over the vocabulary finds its ``k`` nearest examples by exact cosine in a
block-max inverted index, whose blocks are visited in order of their upper bounds until none can still matter.
The neighbours vote with their cosines; isotonic regression on leave-one-out votes turns votes into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ids, list_array, one_text_per_id, prepare, slices, small, stored
from .textkernel import words

MAX_LABELLED, K, MIN_G2, MIN_ODDS, MIN_SUPPORT, BLOCK, CUT = 20_000, 15, 15.0, 4.0, 0.01, 64, 0.5


def _bags(h: np.ndarray, first: np.ndarray, vocab: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count) of all distinct terms; with a sorted ``vocab`` terms are positions in it, others are left out."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if vocab is not None:
        if not len(vocab):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
        hit = vocab[at] == h
        key, count = np.unique(text[hit] * len(vocab) + at[hit], return_counts=True)
        return key // len(vocab), key % len(vocab), count
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], h[at], np.diff(np.append(at, len(h)))


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        h, first = words(b.column(1))
        text, term, count = _bags(h, first)
        n = np.bincount(text, minlength=b.num_rows)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), list_array(term.view(np.int64), n, pa.int64()), list_array(count, n, pa.int32())], ["id", "toxic", "terms", "counts"])


def _bagged(vocab: np.ndarray):
    """Each text's terms of the vocabulary, if any; without an id, in how many texts each one is and, as -1, how many there are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(len(vocab), np.int64), 0
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        for b in slices(batches):
            text, term, count = _bags(*words(b.column(1)), vocab)
            n = np.bincount(text, minlength=b.num_rows)
            df += np.bincount(term, minlength=len(vocab))
            rows += b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(n > 0)), list_array(term, n[n > 0], pa.int32()), list_array(count, n[n > 0], pa.int64())], _BAG)
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip([[None], [[*range(len(vocab)), -1]], [[*df.tolist(), rows]]], kinds)], _BAG)
    return run


_BAG = ["id", "terms", "counts"]


class Index:
    """Block-max inverted index over unit TF-IDF vectors of examples given as (example, term, weight)."""

    def __init__(self, example: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, terms: int, block: int = BLOCK):
        self.n, self.block, self.blocks = n, block, max(1, -(-n // block))
        order = np.lexsort((example, term))
        self.example, self.weight, term = example[order], weight[order], term[order]
        # postings of (term, block) are at start[term, block] to start[term, block + 1]
        key = term * (self.blocks + 1) + self.example // block
        self.start = np.searchsorted(key, np.arange(terms * (self.blocks + 1))).reshape(terms, -1)
        self.most = np.zeros((terms, self.blocks), np.float64)
        np.maximum.at(self.most, (term, self.example // block), self.weight)

    def nearest(self, term: np.ndarray, weight: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest positive dot products, largest first, ties by example; exact."""
        bound = weight @ self.most[term]
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        ids_, scores, worst, step, i = np.zeros(0, np.int64), np.zeros(0), 0.0, 4, 0
        while i < len(order):
            take = order[i : i + step]
            take = take[bound[take] >= worst - 1e-12]
            if not len(take):
                break
            i, step = i + step, step * 2
            lo, hi = self.start[term][:, take], self.start[term][:, take + 1]
            size = (hi - lo).ravel()
            at = np.repeat(lo.ravel() - np.cumsum(size) + size, size) + np.arange(size.sum())
            row = np.repeat(np.arange(len(term)), size.reshape(lo.shape).sum(1))
            found, back = np.unique(self.example[at], return_inverse=True)
            score = np.bincount(back, self.weight[at] * weight[row])
            keep = found != without
            ids_, scores = np.append(ids_, found[keep]), np.append(scores, score[keep])
            best = np.lexsort((ids_, -scores.round(12)))[:k]
            ids_, scores = ids_[best], scores[best]
            worst = scores[-1] if len(scores) == k else 0.0
        return ids_, scores


def tfidf(text: np.ndarray, term: np.ndarray, count: np.ndarray, idf: np.ndarray, n: int) -> np.ndarray:
    """Weights (1 + ln tf) idf, of unit length for each text."""
    w = (1 + np.log(count)) * idf[term]
    length = np.sqrt(np.bincount(text, w * w, minlength=n))
    return w / length[text]


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing least-squares fit of y to x (pool adjacent violators)."""
    value, weight, at = [], [], []
    xs, back = np.unique(x, return_inverse=True)
    mean, size = np.bincount(back, y) / np.bincount(back), np.bincount(back)
    for a, m, s in zip(xs, mean, size):
        value.append(m), weight.append(s), at.append(a)
        while len(value) > 1 and value[-2] >= value[-1]:
            v, s2 = value.pop(), weight.pop()
            at.pop()
            value[-1] = (value[-1] * weight[-1] + v * s2) / (weight[-1] + s2)
            weight[-1] += s2
    return np.array(at), np.array(value)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", max_labelled: int = MAX_LABELLED, k: int = K, min_g2: float = MIN_G2, min_odds: float = MIN_ODDS, min_support: float = MIN_SUPPORT) -> dict | None:
    """The model: vocabulary, idf, index, labels and calibration; None if there are no labelled texts of both kinds."""
    d = ids(docs, key, text)
    marks = ids(labels, key, "toxic").where("toxic is not null").groupBy(key).agg(F.max("toxic").alias("toxic"))
    rows = marks.orderBy(F.xxhash64(F.col(key).cast("long")), key).limit(max_labelled)
    sample = one_text_per_id(d.join(F.broadcast(rows.select(key)), key, "left_semi"), key, text).join(rows, key)
    bags = stored(sample.select(F.col(key).cast("long").alias("id"), text, F.col("toxic").cast("int").alias("toxic"))
                  .mapInArrow(_terms, "id long, toxic int, terms array<long>, counts array<int>"))
    n1, n0 = bags.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    if not n1 or not n0:
        return None
    # one of rows that hold the same terms stands for all, so that copies don't make a term look telling
    distinct = bags.groupBy(F.xxhash64("terms").alias("h")).agg(F.max("toxic").alias("toxic"), F.first("terms").alias("terms"))
    m1, m0 = distinct.agg(F.count_if(F.col("toxic") > 0), F.count_if(F.col("toxic") <= 0)).first()
    a, b = F.col("a"), F.col("b")

    def part(o, row, col):  # one cell of the likelihood ratio
        return F.when(o > 0, o * F.ln(o * (m1 + m0) / (row * col))).otherwise(0.0)

    g2 = 2 * (part(a, a + b, F.lit(m1)) + part(b, a + b, F.lit(m0)) + part(m1 - a, m1 + m0 - a - b, F.lit(m1)) + part(m0 - b, m1 + m0 - a - b, F.lit(m0)))
    odds = F.abs(F.ln((a + 0.5) * (m0 - b + 0.5) / ((b + 0.5) * (m1 - a + 0.5))))
    picked = (distinct.select("toxic", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count_if(F.col("toxic") > 0).cast("double").alias("a"), F.count_if(F.col("toxic") <= 0).cast("double").alias("b"))
              .where((a + b >= max(3.0, min_support * min(m1, m0))) & (g2 >= min_g2) & (odds >= float(np.log(min_odds)))).select("term").toPandas()["term"].to_numpy(np.int64))
    vocab = np.sort(picked.view(np.uint64))
    texts, kind = d.select(F.col(key).cast("long").alias("id"), text), "id long, terms array<int>, counts array<long>"
    every = stored(texts.mapInArrow(_bagged(vocab), kind))
    cell = every.where("id is null").select(F.explode(F.arrays_zip("terms", "counts")).alias("x"))
    counted = cell.groupBy(F.col("x.terms").alias("term")).agg(F.sum("x.counts").alias("df")).toPandas()
    df = np.zeros(len(vocab) + 1)
    df[counted["term"].to_numpy()] = counted["df"].to_numpy()
    idf = np.log((df[-1] + 1) / (df[:-1] + 1)) + 1
    examples = _examples(texts, text, every.where("id is not null"), marks.select(F.col(key).cast("long").alias("id"), "toxic"), vocab, k, kind)
    text_, term, weight, n = _vectors(examples, idf)
    name = examples["id"].to_numpy()
    index = Index(text_, term, weight, n, len(vocab))
    model = {"vocab": vocab, "idf": idf, "index": index, "y": (examples["toxic"].to_numpy() > 0).astype(np.float64), "ids": name, "k": k}
    # of the sample only terms of the vocabulary come to the driver
    got = bags.mapInArrow(_keep(vocab), "id long, toxic int, terms array<int>, counts array<int>").orderBy("id").toArrow()
    text_, term, weight, n = _vectors(got, idf)
    y = (got["toxic"].to_numpy() > 0).astype(np.float64)
    votes, cut = np.zeros(n), np.searchsorted(text_, np.arange(n + 1))
    own = np.searchsorted(name, got["id"].to_numpy())
    for i in np.flatnonzero(np.diff(cut)):
        s = slice(cut[i], cut[i + 1])
        itself = int(own[i]) if own[i] < len(name) and name[own[i]] == got["id"][int(i)].as_py() else -1
        votes[i] = _vote(model, *index.nearest(term[s], weight[s], k, itself))
    model["at"], model["p"] = isotonic(votes, y)
    return model


def _vectors(rows: pa.Table, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(row, term, weight) of rows' terms and counts, and how many rows there are."""
    flat = lambda c: rows[c].combine_chunks().flatten().to_numpy().astype(np.int64) if rows.num_rows else np.zeros(0, np.int64)
    size = pc.list_value_length(rows["terms"]).to_numpy() if rows.num_rows else np.zeros(0, np.int64)
    row, term = np.repeat(np.arange(rows.num_rows), size), flat("terms")
    return row, term, tfidf(row, term, flat("counts"), idf, rows.num_rows), rows.num_rows


def _examples(texts: DataFrame, text: str, bags: DataFrame, marks: DataFrame, vocab: np.ndarray, k: int, kind: str) -> pa.Table:
    """All labelled texts (id, toxic, terms, counts) that have a term, by id; of those of equal terms and counts the first k + 1."""
    twice = stored(texts.groupBy("id").count().where("count > 1").select("id"))
    if not twice.isEmpty():  # of rows that repeat an id that of the smallest text counts, with a term or without
        again = one_text_per_id(texts.join(small(twice), "id", "left_semi"), "id", text).mapInArrow(_bagged(vocab), kind)
        bags = bags.join(small(twice), "id", "left_anti").unionByName(again.where("id is not null"))
    first = Window.partitionBy("terms", "counts").orderBy("id")
    held = bags.join(marks, "id").withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1)
    return held.select("id", F.col("toxic").cast("int").alias("toxic"), "terms", "counts").orderBy("id").toArrow()


def _keep(vocab: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = b.column(2)
            h = t.flatten().to_numpy().view(np.uint64)
            at = np.minimum(np.searchsorted(vocab, h), max(0, len(vocab) - 1))
            hit = vocab[at] == h if len(vocab) else np.zeros(len(h), bool)
            row = np.repeat(np.arange(b.num_rows), np.diff(np.asarray(t.offsets)))
            n = np.bincount(row[hit], minlength=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), list_array(at[hit], n, pa.int32()), list_array(b.column(3).flatten().to_numpy()[hit], n, pa.int32())], ["id", "toxic", "terms", "counts"])
    return run


def _vote(model: dict, near: np.ndarray, cosine: np.ndarray) -> float:
    """Share of the toxic neighbours, each with the weight of its cosine; 0 without neighbours."""
    return float((cosine * model["y"][near]).sum() / cosine.sum()) if len(near) else 0.0


def probability(model: dict, votes: np.ndarray) -> np.ndarray:
    """Calibrated probability: linear between the knots of the isotonic fit."""
    return np.interp(votes, model["at"], model["p"])


def _score(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = broadcast.value
        for b in slices(batches):
            h, first = words(b.column(1))
            text, term, count = _bags(h, first, model["vocab"])
            weight = tfidf(text, term, count, model["idf"], b.num_rows)
            cut = np.searchsorted(text, np.arange(b.num_rows + 1))
            votes, near, cos, size = np.zeros(b.num_rows), [], [], np.zeros(b.num_rows, np.int64)
            for i in np.flatnonzero(np.diff(cut)):
                e, c = model["index"].nearest(term[cut[i] : cut[i + 1]], weight[cut[i] : cut[i + 1]], model["k"])
                votes[i], size[i] = _vote(model, e, c), len(e)
                near.append(model["ids"][e]), cos.append(c)
            none = [np.zeros(0)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(probability(model, votes)), list_array(np.concatenate(near or none).astype(np.int64), size, pa.int64()), list_array(np.concatenate(cos or none).round(6), size, pa.float64())],
                ["doc_id", "toxicity", "neighbours", "cosines"])
    return run


def score(docs: DataFrame, model: dict | None, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """(doc_id, toxicity, toxic, neighbours, cosines) for each row: calibrated probability, decision and evidence.

    Null and empty texts, and texts without a term of the vocabulary, have no neighbours and the probability of
    labelled texts without any.  Equal cosines are taken in order of the example's id.  Repeated rows are scored
    each; rows without an id are left out; other columns are never read.  Without a model all are 0.
    """
    d = ids(docs, key, text).select(F.col(key).cast("long").alias("doc_id"), text)
    if model is None:
        return d.select("doc_id", F.lit(0.0).alias("toxicity"), F.lit(False).alias("toxic"), F.array().cast("array<long>").alias("neighbours"), F.array().cast("array<double>").alias("cosines"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # k + 1 examples at most of each vector that labelled texts have
    out = d.mapInArrow(_score(shared), "doc_id long, toxicity double, neighbours array<long>, cosines array<double>")
    return out.select("doc_id", "toxicity", (F.col("toxicity") >= cut).alias("toxic"), "neighbours", "cosines")


def reject(docs: DataFrame, model: dict | None, text: str = "text", cut: float = CUT) -> DataFrame:
    """The table without its toxic rows, decided row by row on the text alone; all columns as they are.

    Null and empty texts are decided like texts without neighbours, long ones as a whole, repeated rows each; rows
    without an id stay or go like others.  Without a model, and of an empty table, every row stays.
    """
    if model is None:
        return docs
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _score(shared)
        for t in texts:
            rows = pa.RecordBatch.from_arrays([pa.array(np.arange(len(t))), t], ["id", "text"])
            got = [b.column(1).to_numpy() for b in judge(iter([rows]))]
            yield pa.array(np.concatenate([*got, np.zeros(0)]) < cut)

    return docs.where(F.arrow_udf(run, "boolean")(F.col(text)))
