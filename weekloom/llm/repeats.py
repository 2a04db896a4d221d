"""Passages that stand more than once, by FM-indexes over shards of the text around common anchors.

No index holds the corpus. Every window of ``window`` words is named by its anchor, the smallest
hash among its word groups of ``GRAM``; windows that are equal have the same anchor, so the
stretch of windows around one anchor need only meet the stretches around the same anchor. Anchors
that occur once need no search. Of the others each different stretch is taken once, with its
number of copies, and goes to the shard that its anchor's hash names; there the shard's FM-index
is built and all its stretches are streamed past it: matching statistics by backward search say
from which word on ``window`` words stand at least twice.

An anchor with very many different stretches (a phrase that a third of all texts hold) would make
a shard large. Its windows are anchored again, each by itself as a whole, so that equal windows
meet and nothing else; the way back is the same.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm import wordstream
from weekloom.llm.fmindex import Index
from weekloom.llm.scan import mix
from weekloom.staging import stage

U = np.uint64
WINDOW, GRAM = 35, 12
SHARD_WORDS = 1 << 18
#: An anchor of more different stretches than this is taken apart into whole windows.
HOT = 4096
BASE = U(0x9E3779B97F4A7C15)


def _powers(base: U, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    out[:1] = 1
    return np.multiply.accumulate(out)


INVERSE = U(pow(int(BASE), -1, 1 << 64))


def grams(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of every ``size`` words in a row."""
    m = max(len(h) - size + 1, 0)
    out = np.zeros(m, U)
    for j, weight in enumerate(mix(np.arange(size, dtype=U) + U(901)) | U(1)):
        out += h[j : j + m] * weight
    return mix(out)


def stretches(h: np.ndarray, starts: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(key, content hash, first word, words)`` of every maximal run of windows with one anchor.

    The anchor is the leftmost smallest of the window's groups of ``gram`` words.
    """
    n = len(h) - window + 1
    if n <= 0:
        return (np.zeros(0, U),) * 2 + (np.zeros(0, np.int64),) * 2
    g = grams(h, gram)
    low = (g & ~U(0xFFFFFFFF)) | np.arange(len(g), dtype=U)
    span = window - gram + 1
    width = 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[span - width : span - width + n])
    anchor = (low & U(0xFFFFFFFF)).astype(np.int64)
    text = np.searchsorted(starts, np.arange(n), "right")
    at = np.flatnonzero(text == np.searchsorted(starts, np.arange(window - 1, window - 1 + n), "right"))
    if not len(at):
        return (np.zeros(0, U),) * 2 + (np.zeros(0, np.int64),) * 2
    anchor, text = anchor[at], text[at]
    new = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = at[new]
    size = np.diff(np.append(new, len(at))) + window - 1
    sums = np.concatenate([np.zeros(1, U), np.cumsum(mix(h) * _powers(BASE, len(h)))])
    content = (sums[first + size] - sums[first]) * _powers(INVERSE, len(h))[first]
    return g[anchor[new]], mix(content + size.astype(U)), first, size


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(U).view(np.int64))


def _lists(values: pa.Array, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), values)


ANCHORS = "u long, v int, key array<long>, seg array<long>, first array<int>, size array<int>"


def _anchors(window: int, gram: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in wordstream.slices(batch.column(2)):
                h, starts = wordstream.hashed([wordstream.words(t) for t in texts])
                key, seg, first, size = stretches(h, starts[1:], window, gram)
                text = np.searchsorted(starts, first, "right") - 1
                count = np.bincount(text, minlength=len(texts))
                rows = [batch.column(k).slice(at, len(texts)) for k in (0, 1)]
                rows += [_lists(v, count) for v in (_signed(key), _signed(seg), pa.array((first - starts[text]).astype(np.int32)),
                                                    pa.array(size.astype(np.int32)))]
                yield pa.RecordBatch.from_arrays(rows, [f.split()[0] for f in ANCHORS.split(", ")])

    return find


PAYLOAD = "key long, seg long, n long, words binary"


def _payload(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(text, parts)``: the word hashes of each part."""
    for batch in batches:
        for at, texts in wordstream.slices(batch.column(0)):
            h, starts = wordstream.hashed([wordstream.words(t) for t in texts])
            parts = batch.column(1).slice(at, len(texts))
            text = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
            flat = parts.flatten()
            first, size, key, seg, n = (flat.field(k) for k in ("first", "size", "key", "seg", "n"))
            begin = starts[text] + first.to_numpy()
            words = [h[i : i + k].tobytes() for i, k in zip(begin.tolist(), size.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([key, seg, n, pa.array(words, pa.binary())], ["key", "seg", "n", "words"])


def _windows(window: int):
    """Rows of payload: the hash of each window."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                h = np.frombuffer(batch.column(3)[i].as_py(), U)
                own = grams(h, window)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(i, 1) for k in range(3)), _lists(_signed(own), np.array([len(own)]))],
                    ["key", "seg", "n", "windows"])

    return find


def _cut(window: int):
    """Rows ``(n, words, place, window)``: the words of one window."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [raw[8 * i : 8 * (i + window)] for raw, i in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(3), batch.column(3), batch.column(0), pa.array(words, pa.binary())],
                                             ["key", "seg", "n", "words"])

    return cut


FOUND = "key long, seg long, spans array<struct<lo:int,hi:int>>"
SPAN = pa.struct([("lo", pa.int32()), ("hi", pa.int32())])


def _spans(first: np.ndarray, window: int) -> list[dict[str, int]]:
    """Word intervals that windows from these places on cover."""
    if not len(first):
        return []
    new = np.append(True, np.diff(first) > window)
    ends = np.append(np.flatnonzero(new)[1:], len(first)) - 1
    return [{"lo": a, "hi": b + window} for a, b in zip(first[new].tolist(), first[ends].tolist(), strict=True)]


def search_shard(words: np.ndarray, sizes: np.ndarray, copies: np.ndarray, window: int) -> list[list[dict[str, int]]]:
    """For each text the word intervals covered by windows that the texts hold twice, with their copies."""
    # what counts is whether there is another place: two copies stand for more
    index = Index(words, sizes, np.minimum(copies, 2))
    long = index.matching(words, sizes, 2) >= window
    first = np.cumsum(sizes) - sizes
    hits = np.flatnonzero(long)
    bounds = np.searchsorted(hits, np.append(first, len(words)))
    return [_spans(hits[bounds[i] : bounds[i + 1]] - first[i], window) for i in range(len(sizes))]


def _search(window: int):
    def found(held: dict) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        words = np.concatenate([np.frombuffer(w, U) for w, _ in held.values()])
        sizes = np.array([len(w) // 8 for w, _ in held.values()])
        copies = np.array([n for _, n in held.values()])
        spans = search_shard(words, sizes, copies, window)
        keep = [(k, s) for k, s in zip(held, spans, strict=True) if s]
        if keep:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in keep], pa.int64()), pa.array([k[1] for k, _ in keep], pa.int64()),
                 pa.array([s for _, s in keep], pa.list_(SPAN))], ["key", "seg", "spans"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``(shard, key, seg, n, words)`` sorted by shard; equal rows of the corpus give equal payload."""
        shard, held = None, {}
        for batch in batches:
            for s, key, seg, n, words in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if s != shard:
                    yield from found(held)
                    shard, held = s, {}
                held[key, seg] = (words, n)
        yield from found(held)

    return search


def _sharded(payload: DataFrame, words: int, window: int, shard_words: int) -> DataFrame:
    """Search all stretches, in shards of about ``shard_words`` words."""
    shards = 1 + words // shard_words
    rows = payload.select(F.pmod("key", F.lit(shards)).alias("shard"), "key", "seg", "n", "words")
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(_search(window), FOUND)


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts and 96 bits that name the row by id and text."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.xxhash64("doc_id", text).alias("u"), F.hash(text, "doc_id").alias("v"))


def _payload_of(texts: DataFrame, segs: DataFrame) -> DataFrame:
    """The words of one stretch of each kind, from the row that was chosen for it."""
    part = F.struct("first", "size", "key", "seg", "n")
    wanted = segs.select("rep.*", "key", "seg", "n").groupBy("u", "v").agg(F.collect_list(part).alias("parts"))
    return texts.join(wanted, ["u", "v"]).select("text", "parts").mapInArrow(_payload, PAYLOAD)


def _by_windows(payload: DataFrame, window: int, shard_words: int) -> DataFrame:
    """As a search of ``payload`` would give, by whole windows."""
    payload = stage(payload.dropDuplicates(["key", "seg"]), "hot")
    listed = payload.mapInArrow(_windows(window), "key long, seg long, n long, windows array<long>")
    places = stage(listed.select("key", "seg", "n", F.posexplode("windows").alias("place", "window")), "places")
    again = places.groupBy("window").agg(F.sum("n").alias("n"), F.min(F.struct("key", "seg", "place")).alias("rep")).where("n > 1")
    again = stage(again.select("window", "n", "rep.*"), "again")
    rows = again.join(payload.select("key", "seg", "words"), ["key", "seg"]).select("n", "words", "place", "window")
    count = again.agg(F.count(F.lit(1)).alias("n")).first()
    found = _sharded(rows.mapInArrow(_cut(window), PAYLOAD), (window + 1) * count["n"], window, shard_words)
    back = places.join(found.select(F.col("key").alias("window")), "window").select(
        "key", "seg", F.struct(F.col("place").alias("lo"), (F.col("place") + window).cast("int").alias("hi")).alias("span"))
    return back.groupBy("key", "seg").agg(F.collect_list("span").alias("spans"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_words: int = SHARD_WORDS, hot: int = HOT) -> DataFrame:
    """``(u, v, spans)``: for every row, named by ``_keyed``, intervals of words that stand elsewhere too.

    Intervals are those of stretches and may overlap; rows without any do not appear.
    """
    if not 1 <= gram <= window:
        raise ValueError("the group of words of an anchor lies within the window")
    texts = _keyed(docs)
    rows = stage(texts.select("u", "v", "text").where("text is not null").mapInArrow(_anchors(window, gram), ANCHORS)
                 .where("size(key) > 0"), "anchors")
    keys = stage(rows.select(F.explode("key").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"), "keys")
    each = rows.select("u", "v", F.inline(F.arrays_zip("key", "seg", "first", "size")))
    each = stage(each.join(keys, "key"), "common")
    segs = stage(each.groupBy("key", "seg").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("u", "v", "first", "size")).alias("rep")), "stretches")
    busy = stage(segs.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > hot).select("key"), "busy")
    total = segs.agg(F.sum((F.col("rep.size") + 1) * F.least(F.col("n"), F.lit(2))).alias("words")).first()
    # read by both ways, so that texts are shuffled once
    payload = stage(_payload_of(texts, segs), "payload")
    any_busy = busy.limit(1).count() > 0
    calm = payload.join(busy, "key", "left_anti") if any_busy else payload
    found = [_sharded(calm, total["words"] or 0, window, shard_words)]
    if any_busy:
        found.append(_by_windows(payload.join(busy, "key", "left_semi"), window, shard_words))
    for k, part in enumerate(found):
        found[k] = stage(part, "found")
    where = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    span = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("first")).alias("lo"), (s["hi"] + F.col("first")).alias("hi")))
    own = each.join(where, ["key", "seg"]).select("u", "v", span.alias("spans"))
    return own.groupBy("u", "v").agg(F.flatten(F.collect_set("spans")).alias("spans"))


def merged(spans: list[dict[str, int]] | None) -> list[list[int]]:
    """Intervals in order, those that touch as one."""
    out: list[list[int]] = []
    for lo, hi in sorted((s["lo"], s["hi"]) for s in spans or []):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return out


def _rest(held: list[bytes], spans: list[list[int]]) -> list[bytes]:
    out, at = [], 0
    for lo, hi in spans:
        out += held[at:lo]
        at = hi
    return out + held[at:]


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(batch, rows' words, spans)`` slice by slice of ``(doc_id, text, spans)``."""
    for batch in batches:
        for at, texts in wordstream.slices(batch.column(1)):
            part = batch.slice(at, len(texts))
            yield part, [wordstream.words(t) for t in texts], [merged(s) for s in part.column(2).to_pylist()]


def _with_spans(docs: DataFrame, **how) -> DataFrame:
    """``(doc_id, text, spans)`` of every row; one shuffle of texts."""
    spans = stage(repeated_spans(docs, **how), "spans")
    return _keyed(docs).join(spans, ["u", "v"], "left").select("doc_id", "text", "spans")


def repeated_passages(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """``(doc_id, first, words, passage)``: every stretch of words covered by windows that stand elsewhere too.

    A window is ``window`` words in a row of one text, words are runs of other characters than the
    six ASCII blanks; elsewhere is any other place, of the same text too. One row for each maximal
    stretch, ``passage`` its words joined by one blank. Null and empty texts hold none, a null
    doc_id stays null, rows equal in id and text are places of their own and both appear. An empty
    table gives no rows; extra columns are not read.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held, spans in _apply(batches):
            ids = part.column(0).to_pylist()
            rows = [{"doc_id": i, "first": lo, "words": hi - lo, "passage": b" ".join(w[lo:hi]).decode()}
                    for i, w, s in zip(ids, held, spans, strict=True) for lo, hi in s]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("words", pa.int64()), ("passage", pa.string())]))

    return _with_spans(docs, window=window, **how).mapInArrow(cut, "doc_id long, first long, words long, passage string")


def kept_digests(docs: DataFrame, window: int = WINDOW, **how) -> DataFrame:
    """Every row with its number of words, of those in repeated passages, and a digest of the rest.

    Rows as in ``repeated_passages``; a row without words has none removed and the digest of nothing.
    """
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held, spans in _apply(batches):
            rest = [_rest(w, s) for w, s in zip(held, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(w) for w in held], pa.int64()),
                 pa.array([len(w) - len(r) for w, r in zip(held, rest, strict=True)], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(r)).hexdigest() for r in rest], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return _with_spans(docs, window=window, **how).mapInArrow(digest, schema)
