"""Mixing to target weights with soft membership.

A classifier learned from the labelled table gives every document a posterior over domains.
Nonnegative document rates are then fitted by projected gradient, so that the expected tokens of
each domain, the sum of rate x tokens x posterior, come as near to the targets as they can.

The gradient of a document depends on the corpus only through the K residuals, so one pass is
one aggregation of K sums over the stored posteriors, and a rate is a function of its posterior
and of the K-vectors of the passes so far: no rate table is rewritten between the passes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import scan
from weekloom.staging import stage

U = np.uint64
#: The labelled classes a document may belong to: good or poor text, toxic or not.
DOMAINS = ("good", "good_toxic", "poor", "poor_toxic")
#: Share of the expected tokens wanted from each.
TARGET = {"good": 0.94, "good_toxic": 0.02, "poor": 0.035, "poor_toxic": 0.005}
FEATURE_BITS = 18
#: Added to the curvature of a step of the rates.
DAMPING = 1e-5


@dataclass
class Classifier:
    """Multinomial logistic regression on hashed words, damped by the square root of the length."""

    weights: np.ndarray  # 2^FEATURE_BITS x K
    prior: np.ndarray  # K log priors


def features(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature and row of each word, and the words of each row."""
    h, row = scan.words(data, at, scan.NOT_ALNUM, fold=True)
    return (h >> U(64 - FEATURE_BITS)).astype(np.int64), row, np.bincount(row, minlength=len(at) - 1)


def signs(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Shares of sign bytes, capitals and repeated words: three dense features of each row."""
    lo, hi = int(at[0]), int(at[-1])
    b, n = data[lo:hi], len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    size = np.maximum(np.diff(at), 1)
    sign = (b < 0x80) & scan.NOT_ALNUM[b] & ~scan.BLANKS[b] & (b != 0x2C) & (b != 0x2E)
    big = (b >= 65) & (b <= 90)
    h, owner = scan.words(data, at)
    same = np.append(False, (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])) if len(h) else np.zeros(0, bool)
    words = np.maximum(np.bincount(owner, minlength=n), 1)
    return np.stack([np.bincount(row, sign, n) / size, np.bincount(row, big, n) / size,
                     np.bincount(owner, same, n) / words], 1)


SIGN_ROWS = 3


def logits(model: Classifier, data: np.ndarray, at: np.ndarray) -> np.ndarray:
    n, k = len(at) - 1, len(model.prior)
    f, row, count = features(data, at)
    out = np.stack([np.bincount(row, model.weights[f, j], n) for j in range(k)], 1) if len(f) else np.zeros((n, k))
    out = out / np.sqrt(np.maximum(count, 1))[:, None]
    return out + signs(data, at) @ model.weights[-SIGN_ROWS:] * 10 + model.prior


def softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def learn(texts: list[bytes], y: np.ndarray, prior: np.ndarray, steps: int = 120, rate: float = 0.5, keep: float = 1e-4) -> Classifier:
    """Gradient descent with per-weight steps on the sampled rows, every class with equal weight.

    The class shares of the whole labelled table come back in as ``prior``.
    """
    k = len(prior)
    data = np.frombuffer(b"".join(texts), np.uint8)
    at = np.append(0, np.cumsum([len(t) for t in texts])).astype(np.int64)
    f, row, count = features(data, at)
    dense = signs(data, at) * 10
    value = 1 / np.sqrt(np.maximum(count, 1))[row]
    w = np.zeros(((1 << FEATURE_BITS) + SIGN_ROWS, k))
    have = np.bincount(y, minlength=k)
    each = (1 / np.maximum(have, 1))[y] / max((have > 0).sum(), 1)
    goal = np.eye(k)[y]
    used, place = np.unique(f, return_inverse=True)
    local = np.zeros((len(used), k))
    local_sign = np.zeros((SIGN_ROWS, k))
    seen, seen_sign = np.full_like(local, 1e-8), np.full_like(local_sign, 1e-8)
    for _ in range(steps):
        z = np.stack([np.bincount(row, local[place, j] * value, len(texts)) for j in range(k)], 1) + dense @ local_sign
        d = (softmax(z) - goal) * each[:, None]
        g = np.stack([np.bincount(place, d[row, j] * value, len(used)) for j in range(k)], 1) + keep * local / len(used)
        gs = dense.T @ d
        seen += g * g
        seen_sign += gs * gs
        local -= rate * g / np.sqrt(seen)
        local_sign -= rate * gs / np.sqrt(seen_sign)
    w[used] = local
    w[-SIGN_ROWS:] = local_sign
    return Classifier(w, np.log(np.maximum(prior, 1e-6)))


def classifier(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], each: int = 800, most_bytes: int = 8000) -> Classifier:
    """Learned from up to ``each`` texts of every domain of ``labelled`` ``(doc_id, domain)``.

    The sampled texts have at most ``most_bytes`` bytes and the smallest id hashes of their
    domain. The priors are counted over the whole table. Ids that are null or have two domains
    are left out. Without any labelled text all domains are equally likely.
    """
    k = len(domains)
    marks = labelled.where(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min("domain").alias("domain"), F.max("domain").alias("other")).where("domain = other").select("doc_id", "domain")
    counts = {r["domain"]: r["n"] for r in marks.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    prior = np.array([(counts.get(d, 0) + 1) / (total + k) for d in domains])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.octet_length("text").between(1, most_bytes))
    ids = rows.select("doc_id").join(marks, "doc_id").distinct().withColumn("h", F.xxhash64("doc_id"))
    chosen = None
    for d in domains:
        part = ids.where(F.col("domain") == d).orderBy("h", "doc_id").limit(each)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "domain", "h").agg(F.min("text").alias("text"))
    some = texts.orderBy("h", "doc_id").collect()  # at most each * K short texts
    if not some:
        return Classifier(np.zeros(((1 << FEATURE_BITS) + SIGN_ROWS, k)), np.log(prior))
    y = np.array([domains.index(r["domain"]) for r in some])
    return learn([r["text"].encode() for r in some], y, prior)


def posteriors(docs: DataFrame, model: Classifier) -> DataFrame:
    """``(doc_id, key, tokens, p)``: words of each text and its posterior over the domains.

    ``key`` is a hash of id and text, the same for repeated rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
                       F.col("text").cast("string").alias("text"))
    k = len(model.prior)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = scan.buffers(batch.column(2))
            p, n = [np.zeros((0, k))], [np.zeros(0, np.int64)]
            for i, j in scan.slices(at):
                p.append(softmax(logits(held.value, data, at[i : j + 1])))
                n.append(features(data, at[i : j + 1])[2])
            flat = pa.array(np.concatenate(p).ravel())
            lists = pa.ListArray.from_arrays(pa.array((np.arange(batch.num_rows + 1) * k).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.concatenate(n)), lists],
                                             ["doc_id", "key", "tokens", "p"])

    return rows.mapInArrow(run, "doc_id long, key long, tokens long, p array<double>")


def _dot(g: list[float]):
    terms = [F.element_at("p", j + 1) * F.lit(float(x)) for j, x in enumerate(g)]
    return sum(terms[1:], terms[0])


def fit_rates(rows: DataFrame, target: np.ndarray, most: float = 4.0, passes: int = 40, near: float = 1e-4, fold: int = 6) -> DataFrame:
    """``rows`` with a ``rate`` in 0..``most`` whose expected domain totals match the targets.

    ``target``: share of the expected tokens wanted from each domain; the total stays that of
    the input. The objective is the sum of the squared residuals. A step is scaled by the
    curvature over the rows whose rate is free to move, the matrix of token-weighted products of
    posteriors, which the pass sums up beside the residual; a residual that grows raises the
    damping of that scale. Documents are weighted by their tokens. Passes end once every domain
    is within ``near`` of its target (as a share of all tokens) or no residual moves by a tenth
    of that: a target beyond what ``most`` allows does not keep the others from theirs. Every
    ``fold`` passes the rates are written, which keeps the expression short. An empty table
    comes back empty.
    """
    k = len(target)
    rows = rows.withColumn("rate", F.lit(1.0))
    goal = np.asarray(target, float) / np.sum(target)
    history: list[list[float]] = []
    last, damping = None, DAMPING
    start = F.col("rate")

    def rate():
        r = start
        for g in history:
            r = F.greatest(F.lit(0.0), F.least(F.lit(float(most)), r - _dot(g)))
        return r

    share = [F.col("tokens") * F.element_at("p", j + 1) for j in range(k)]
    free = (F.col("rate") > 0) & (F.col("rate") < most)
    curves = [F.sum(F.when(free, share[i] * F.element_at("p", j + 1))).alias(f"m{i}_{j}") for i in range(k) for j in range(i, k)]
    totals = [F.sum(share[j] * F.col("rate")).alias(f"s{j}") for j in range(k)]
    for _ in range(passes):
        sums = rows.select("tokens", "p", rate().alias("rate")).agg(
            F.sum(F.col("tokens").cast("double")).alias("t"), *totals, *curves).first()
        total = sums["t"] or 0.0
        if not total:
            break
        e = np.array([sums[f"s{j}"] for j in range(k)]) / total - goal
        if np.abs(e).max() <= near or last is not None and np.abs(e - last).max() <= near / 10:
            break
        if last is not None and e @ e > last @ last:
            damping *= 10
        last = e
        m = np.array([[sums[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)]) / total
        history.append(np.linalg.solve(m + damping * np.eye(k), e).tolist())
        if len(history) == fold:
            rows = stage(rows.withColumn("rate", rate()), "rates")
            history = []
    return rows.withColumn("rate", rate())


def labelled_domains(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from a table with quality and toxic marks; rows lacking one are left out."""
    name = F.concat(F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor"),
                    F.when(F.col("toxic") == 1, "_toxic").when(F.col("toxic") == 0, ""))
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), name.alias("domain")).where("domain is not null")


def copies(seed: int = 11):
    """How often a row is taken: its rate, rounded up or down by a hash of the row."""
    share = F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(F.col("rate") + share).cast("int")


def mixture(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET, most: float = 4.0) -> DataFrame:
    """``(doc_id, key, tokens, p, rate, copies)`` for every row of ``docs``.

    A null or empty text has no tokens, the posterior of the priors, and a rate like any other;
    repeated rows have equal rates; a row without an id is kept. Other columns are not read.
    """
    domains = tuple(target)
    model = classifier(docs, labelled_domains(labels), domains)
    rows = stage(posteriors(docs, model), "posteriors")
    rows = fit_rates(rows, np.array([target[d] for d in domains]), most)
    return stage(rows, "rates").withColumn("copies", copies())


def mix(docs: DataFrame, labels: DataFrame, target: dict[str, float] = TARGET, most: float = 4.0) -> DataFrame:
    """``docs`` with each row repeated by its copies, possibly not at all, and its own columns.

    Only rows whose count is not one are joined with the corpus.
    """
    other = mixture(docs, labels, target, most).where("copies != 1").select("key", "copies").distinct()
    other = stage(other.select(F.col("key").alias("__key"), F.col("copies").alias("__copies")), "copies")
    taken = other.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    side = F.broadcast(other) if taken <= scan.ID_LIMIT else other
    rows = docs.withColumn("__key", F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    rows = rows.join(side, "__key", "left").withColumn("__copies", F.coalesce("__copies", F.lit(1)))
    rows = rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("__copies"), F.lit(1))))).where("__copies > 0")
    return rows.select(*docs.columns)
