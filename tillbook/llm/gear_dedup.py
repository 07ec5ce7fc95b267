"""Removal of repeated passages by content-defined chunking.

A gear rolling hash runs over the last 16 bytes.  Of the breaks (white space)
of a text the least hash in every ``WINDOW`` breaks that follow each other is
a cut, and so that text without spaces is cut too, any character about every
``2**CHAR_BITS``-th.  Whether a cut stands depends on ``WINDOW`` breaks to
either side alone, so an insertion moves no cut further on; cuts are at most
``WINDOW`` breaks apart.  A chunk begins at every cut and ends at the first cut
that is ``MIN_BYTES`` or more behind it; so chunks may overlap, none is a mere
word or two, and a passage that two texts share has a whole chunk of its own
in both, the same, once it holds some ``4 * WINDOW`` breaks, whatever it says;
most shorter ones have one too.

Chunks are compared by a 64-bit digest.  The document with the smallest id
that has a chunk keeps it; in any later document a chunk that an earlier one
has is repeated.  Neighbouring repeated chunks that stand alike in the document
that keeps them are a seed, one chunk is enough; a seed's bytes are compared by
a checksum too.  Every seed is then extended word by word against the text of
that document, as far as a shared passage can go on without another common
chunk (``REACH`` words, ``REACH_BYTES`` at most where there are no words).
Extended seeds that touch are one run, and a run goes
if it has at least ``min_words`` words, or as many times ``WORD_BYTES`` bytes
as text without spaces may.

Defined results: null text stays null and empty text empty, with no chunks;
rows with a null id keep their text and are no source for others; repeats
within one document stay; rows that repeat an id are the same document and
remove nothing from each other; extra columns pass through, one that has the
name of the spans with ``__`` before it; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tillbook.functions import sieve, spread
from tillbook.llm.textnp import IS_SPACE, Block, blocks, segment_hashes
from tillbook.session import materialize

WINDOW = 12
CHAR_BITS = 10
MIN_BYTES = 16
MIN_WORDS = 16
REACH = 2 * WINDOW + 4
REACH_BYTES = 16_384
BLOCK_BYTES = 1 << 18   # of text that are chunked at once: some fifty bytes of arrays stand beside each
ROWS = 256              # documents that are Python objects at once
WORD_BYTES = 16         # a run without breaks counts as a word for so many bytes
_BREAKS = frozenset(b" \t\n\x0b\x0c\r")
_SPACES = re.compile(rb"[ \t-\r]+")
_REACHED = re.compile(rb"(?:[^ \t-\r]*[ \t-\r]+){%d}" % REACH)
_GEAR = np.random.default_rng(5).integers(0, 1 << 32, 256, dtype=np.uint32)

_CHUNKS = "doc_id long, start int, stop int, digest long"
_SLICES = "first_doc long, f_start int, f_stop int, crc long, head binary, tail binary, opens boolean, ends boolean"
_SPAN = T.StructType().add("start", "integer").add("stop", "integer").add("n_words", "integer").add("first_doc", "long")


def gear(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rolling hash of the 16 bytes of the row up to each position, by doubling windows."""
    value = _GEAR[data]
    into = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    for width in (1, 2, 4, 8):
        if len(value) > width:
            value[width:] = value[width:] + np.where(into[width:] >= width, value[:-width] << np.uint32(width), np.uint32(0))
    return value


def window_minima(value: np.ndarray, row: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """Which values are the least of some ``width`` neighbours of their row (equal ones alike); ``row`` is sorted."""
    at = np.arange(len(value)) + (row + 1) * width                  # rows stand ``width`` apart
    line = np.full((at[-1] + width + 1) if len(at) else 0, np.iinfo(np.int64).max)
    line[at] = value
    n = len(line) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=bool)
    least = line[:n].copy()
    for k in range(1, width):
        np.minimum(least, line[k:k + n], out=least)
    most = np.full(len(line), -1, dtype=np.int64)                   # greatest of the minima of all windows that hold a place
    for k in range(width):
        np.maximum(most[k:k + n], least, out=most[k:k + n])
    return most[at] == value


def chunk_bounds(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Byte ranges of all chunks of a block, by their ends; none spans two rows."""
    data = block.data
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    value = gear(data, block.offsets)
    whole = np.ones(len(data), dtype=bool)                  # next byte begins a character
    whole[:-1] = (data[1:] & 0xC0) != 0x80
    breaks = np.flatnonzero(IS_SPACE[data])
    row = np.searchsorted(block.offsets, breaks, side="right") - 1
    chosen = breaks[window_minima(value[breaks].astype(np.int64), row)]
    anywhere = np.flatnonzero(whole & (value >> np.uint32(32 - CHAR_BITS) == 0))
    cuts = np.unique(np.concatenate([chosen + 1, anywhere + 1, block.offsets]))
    of = np.searchsorted(block.offsets, cuts, side="right") - 1         # the row that a cut begins or lies in
    stops = cuts[np.minimum(np.searchsorted(cuts, cuts + MIN_BYTES), len(cuts) - 1)]
    # the last chunk of a row ends with it, and begins no later than the row
    stops = np.minimum(stops, block.offsets[np.minimum(of + 1, len(block.offsets) - 1)])
    inside = cuts < stops
    starts, stops = cuts[inside], stops[inside]
    last = np.ones(len(stops), dtype=bool)                  # of chunks with one end the longest says all
    last[1:] = stops[1:] != stops[:-1]
    return starts[last], stops[last]


def chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> chunks; offsets are UTF-8 bytes of the text."""
    for batch in batches:
        for block in blocks(batch.column(1), BLOCK_BYTES):
            starts, stops = chunk_bounds(block)
            if not len(starts):
                continue
            row = np.searchsorted(block.offsets, starts, side="right") - 1
            base = block.offsets[row]
            ids = batch.column(0).slice(block.first, len(block.offsets) - 1)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row)), *(pa.array((x - base).astype(np.int32)) for x in (starts, stops)),
                 pa.array(segment_hashes(block.data, starts, stops).view(np.int64))],
                names=["doc_id", "start", "stop", "digest"])


def _after(raw: bytes, at: int) -> int:
    """Where ``REACH`` words from ``at`` on end."""
    end = min(len(raw), at + REACH_BYTES)
    found = _REACHED.match(raw, at, end)
    return found.end() if found else end


def _before(raw: bytes, at: int) -> int:
    """Where ``REACH`` words up to ``at`` begin."""
    start = max(0, at - REACH_BYTES)
    ends = [m.start() for m in _SPACES.finditer(raw, start, at)]
    return ends[-REACH] if len(ends) >= REACH else start


def _slice_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, wants) -> the bytes on either side of each wanted range, and its checksum."""
    schema = pa.schema([("first_doc", pa.int64()), ("f_start", pa.int32()), ("f_stop", pa.int32()), ("crc", pa.int64()),
                        ("head", pa.binary()), ("tail", pa.binary()), ("opens", pa.bool_()), ("ends", pa.bool_())])
    for batch in batches:
        for doc, text, wants in zip(*(batch.column(i) for i in range(3))):
            raw = (text.as_py() or "").encode()
            rows = []
            for w in wants.as_py():
                start, stop = w["f_start"], w["f_stop"]
                first, last = _before(raw, start), _after(raw, stop)
                rows.append({"first_doc": doc.as_py(), "f_start": start, "f_stop": stop, "crc": zlib.crc32(raw[start:stop]),
                             "head": raw[first:start], "tail": raw[stop:last], "opens": first == 0, "ends": last == len(raw)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _shared_words(a: bytes, b: bytes, a_whole: bool, b_whole: bool) -> int:
    """Bytes of the whole words that ``a`` and ``b`` both begin with; ``whole``: the text ends where the bytes do."""
    n = min(len(a), len(b))
    if a[:n] != b[:n]:
        n = int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))
    over = lambda x, whole: x[n] in _BREAKS if n < len(x) else whole
    if over(a, a_whole) and over(b, b_whole):
        return n
    while n and a[n - 1] not in _BREAKS:
        n -= 1
    return n


def extended_spans(raw: bytes, seeds: list[dict], min_words: int) -> list[dict]:
    """Runs of a document: its seeds, extended and joined, that have ``min_words`` words."""
    grown = []
    for s in seeds:
        start, stop = s["start"], s["stop"]
        if stop > len(raw) or zlib.crc32(raw[start:stop]) != s["crc"]:
            continue                                            # of another row with this id, or a chance collision
        own = raw[max(0, start - len(s["head"]) - 1):start]
        left = _shared_words(own[::-1], s["head"][::-1], len(own) == start, s["opens"])
        while left and raw[start - left] in _BREAKS:            # the break before the run stays and parts its neighbours
            left -= 1
        right = _shared_words(raw[stop:stop + len(s["tail"]) + 1], s["tail"], stop + len(s["tail"]) + 1 >= len(raw), s["ends"])
        grown.append((start - left, stop + right, start, s["first_doc"]))
    runs: list[list] = []
    for start, stop, _, first in sorted(grown):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(stop, runs[-1][1])
        else:
            runs.append([start, stop, first])
    out = []
    for start, stop, first in runs:
        inside = start > 0 and raw[start - 1] not in _BREAKS and raw[start] not in _BREAKS     # a word that begins before the run
        n_words = len(_SPACES.sub(b" ", raw[start:stop]).split(b" ")) - inside
        n_words -= raw[start] in _BREAKS
        n_words -= raw[stop - 1] in _BREAKS and stop - start > 1
        if n_words >= min_words or stop - start >= min_words * WORD_BYTES:
            out.append({"start": start, "stop": stop, "n_words": n_words, "first_doc": first})
    return out


def _cutter(min_words: int, spans_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(..., text, seeds) -> the same rows with the runs taken out of text, and the runs as spans."""
        kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("n_words", pa.int32()), ("first_doc", pa.int64())]))
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            names = batch.schema.names
            t, s = names.index("text"), names.index(spans_col)
            texts, spans = [], []
            for text, seeds in zip(batch.column(t).to_pylist(), batch.column(s).to_pylist()):
                found = []
                if seeds and text is not None:
                    raw, at, parts = text.encode(), 0, []
                    found = extended_spans(raw, seeds, min_words)
                    for span in found:
                        parts.append(raw[at:span["start"]])
                        at = span["stop"]
                    text = b"".join([*parts, raw[at:]]).decode()
                texts.append(text)
                spans.append(found)
            columns = list(batch.columns)
            columns[t], columns[s] = pa.array(texts, type=batch.column(t).type), pa.array(spans, type=kind)
            yield pa.RecordBatch.from_arrays(columns, names=names)
    return run


def repeated_seeds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, seeds)`` of documents with repeated chunks, each seed with what stands beside it in the document that keeps it."""
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
             .where("doc_id IS NOT NULL"))
    chunks = texts.mapInArrow(chunk_batches, _CHUNKS)
    seen = (chunks.groupBy("digest").agg(F.min(F.struct("doc_id", "start")).alias("first"), F.max("doc_id").alias("last_doc"),
                                         F.count(F.lit(1)).alias("n"))
            .where("last_doc > first.doc_id").select("digest", F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("f_start"), "n"))
    seen = materialize(seen, "seen")
    # chunks of no repeated digest aren't shuffled, as far as a table of fixed size can tell; those of a busy digest are dealt out
    again = sieve.keep(chunks, materialize(sieve.build(seen, ["digest"]), "sieve"), ["digest"])
    repeated = spread.join(again, seen.drop("n"), ["digest"], ["doc_id", "start"], hot=hot_digests(seen)).where("first_doc < doc_id").drop("digest")
    ordered = repeated.groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "stop", "first_doc", "f_start"))).alias("c"))
    seeds = ordered.select("doc_id", F.explode(_joined("c")).alias("s")).select("doc_id", "s.*")
    seeds = materialize(seeds.select("doc_id", "start", "stop", "first_doc", "f_start",
                                     (F.col("f_start") + F.col("stop") - F.col("start")).alias("f_stop")), "seeds")
    key = ["first_doc", "f_start", "f_stop"]
    wants = seeds.select(*key).distinct().groupBy(F.col("first_doc").alias("doc_id")).agg(F.collect_list(F.struct("f_start", "f_stop")).alias("wants"))
    slices = texts.join(wants, "doc_id").select("doc_id", "text", "wants").mapInArrow(_slice_batches, _SLICES).dropDuplicates(key)
    # a passage of thousands of documents is one key: its seeds are dealt out
    return spread.join(seeds, slices, key, ["doc_id", "start"]).groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "stop", "first_doc", "crc", "head", "tail", "opens", "ends")).alias("seeds"))


def hot_digests(seen: DataFrame) -> dict[int, int]:
    """Hash of the digest -> number of pieces, for those with more chunks than an average partition; fewer than there are partitions."""
    partitions = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = seen.agg(F.sum("n")).first()[0] or 0
    busy = seen.where(F.col("n") * partitions > total).orderBy(F.desc("n")).limit(min(spread.MOST, partitions))
    pieces = spread.FINENESS * partitions
    return {r["key"]: -(-pieces * r["n"] // total) for r in busy.select(F.xxhash64("digest").alias("key"), "n").collect()} if partitions > 1 else {}


def _joined(chunks: str):
    """Join chunks (one document's, ordered) that touch or overlap and stand alike in the same other document."""
    kind = "struct<start:int,stop:int,first_doc:bigint,f_start:int>"
    state = F.struct(F.array().cast(f"array<{kind}>").alias("done"), F.lit(None).cast(kind).alias("open"))

    def step(acc, x):
        o = acc.open
        joins = (o.stop >= x.start) & (o.first_doc == x.first_doc) & (x.f_start - o.f_start == x.start - o.start)
        grown = F.struct(o.start.alias("start"), F.greatest(o.stop, x.stop).alias("stop"), o.first_doc.alias("first_doc"), o.f_start.alias("f_start"))
        return F.struct(
            F.when(joins | o.isNull(), acc.done).otherwise(F.concat(acc.done, F.array(o))).alias("done"),
            F.when(joins, grown).otherwise(x).alias("open"))
    return F.aggregate(chunks, state, step, lambda acc: F.when(acc.open.isNull(), acc.done).otherwise(F.concat(acc.done, F.array(acc.open))))


def remove_repeats(docs: DataFrame, min_words: int = MIN_WORDS, spans: str = "spans") -> DataFrame:
    """``docs`` with repeated runs cut out of ``text``, plus the removed ``spans`` (empty array if none).

    ``spans``: ordered array of ``start, stop`` (UTF-8 bytes), ``n_words`` and
    ``first_doc``, the document that keeps the run's beginning.
    """
    seeds = repeated_seeds(docs)
    docs = docs.withColumnsRenamed({c: f"__{c}" for c in docs.columns if c.lower() == spans.lower()})
    link = "__link"
    while link in {c.lower() for c in docs.columns}:
        link += "_"
    seeds = seeds.select(F.col("doc_id").alias(link), F.col("seeds").alias(spans))
    joined = docs.join(seeds, docs["doc_id"] == seeds[link], "left").drop(seeds[link])
    schema = T.StructType([*joined.schema.fields[:-1], T.StructField(spans, T.ArrayType(_SPAN))])
    return joined.mapInArrow(_cutter(min_words, spans), schema)
