"""Packing of documents into sequences by bounded-space online best-fit.

Every document becomes its token ids and an end id. What is longer than a
sequence is cut into full pieces, the last one shorter; nothing else is cut.
Pieces are packed as they come: an open bin's free space is one bit of an
integer, so the best fit is the lowest set bit at or above the piece's length.
At most ``open_bins`` bins are open; if one more is needed the fullest closes.
Pieces come batch by batch (rows of an Arrow batch, or ``HELD_IDS`` ids of them),
the longest of a batch first, which leaves the short ones to fill the gaps.

Scale. Tokenising and packing are one narrow pass: a task packs its own rows, so
ids are never shuffled. The bins a task leaves open (a fixed number) are then
packed as wholes in groups of 64 tasks, those that stay open again in
groups of 64 groups, until one group is left: no task sees more than 64 times
``open_bins`` rows. Only that small table of moves is joined to the pieces.
Tasks number their bins by partition and order of rows, so a task that runs
again gives the same ones; the pieces are written before they are read twice.

Tokenising (``by_word``). The vocabulary splits at white space, and text further
into runs of letters, digits, endings such as 's and runs of other signs; no
id spans two such units, and the normaliser changes ASCII and Latin-1 letters to
lower case only. So a text's ids are those of its units in order: pre-tokens of
words of those characters, other words whole. A worker keeps the ids of units it has met, as bytes, up to a
fixed number; a document costs a look-up for each unit. A text that spells out a
special token, and any vocabulary that splits otherwise (``by_word=False``),
is encoded as it is.
"""

from __future__ import annotations

import re
import struct
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, small, staged

CAPACITY = 2048
OPEN_BINS = 8192
END_ID = 0
FAN_IN = 64             # groups whose open bins meet in one task
HELD_IDS = 8 << 20      # ids that are held before they are packed
KNOWN = 350_000         # units whose ids a worker keeps, twice at most
KNOWN_CHARS = 64        # longer units are encoded each time
BLANKS = re.compile("[\x20\x09-\x0D]+")
# What the vocabulary file takes for a unit, for lower-case ASCII
# and Latin-1 letters; and any character beside those.
UNITS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\x20\x09-\x0Da-z0-9ß-öø-ÿ]+")
OTHER = re.compile("[^\x00-\x7FÀ-ÖØ-öø-ÿ]")


class _Known(dict):
    """Ids by unit. When it is full it becomes the old generation, from which
    units that are met again are taken over."""

    def __init__(self, encode):
        self.encode, self.old = encode, {}

    def __missing__(self, unit: str) -> bytes:
        out = self.old.get(unit)
        if out is None:
            out = self.encode(unit)
        if len(unit) <= KNOWN_CHARS:
            if len(self) >= KNOWN:
                self.old = dict(self)
                self.clear()
            self[unit] = out
        return out


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, tokenizer_json: str, by_word: bool = True):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenize = self.tokenizer.model.tokenize
        self.as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if by_word else [""]
        self.known = _Known(self._unit)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _unit(self, unit: str) -> bytes:
        if unit.isalpha() and not OTHER.search(unit):     # one pre-token
            if not unit.isascii():
                unit = self.as_bytes.pre_tokenize_str(unit)[0][0]
            found = self.tokenize(unit)
            return struct.pack(f"<{len(found)}I", *[t.id for t in found])
        return self._whole(unit)

    def encode(self, text: str) -> bytes:
        if any(m in text for m in self.marks):
            return self._whole(text)
        if not OTHER.search(text):
            units = UNITS.findall(text.lower())
        else:
            units = []
            for word in BLANKS.split(text):
                if not OTHER.search(word):
                    units += UNITS.findall(word.lower())
                else:
                    units.append(word)
        return b"".join(map(self.known.__getitem__, units))


class BestFit:
    """Open bins keyed by free space: bit f of ``bits`` is set while a bin with
    f free places is open."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.most = capacity, open_bins
        self.bits, self.open, self.bins = 0, 0, 0
        self.free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, space: int) -> int:
        bin_ = self.free[space].pop()
        if not self.free[space]:
            self.bits ^= 1 << space
        self.open -= 1
        return bin_

    def put(self, length: int) -> tuple[int, int]:
        """(bin, offset) of the next item; bins are numbered as they open."""
        fit = self.bits >> length
        if fit:
            space = length + (fit & -fit).bit_length() - 1
            bin_ = self._take(space)
        else:
            space, bin_ = self.capacity, self.bins
            self.bins += 1
        left = space - length
        if left:
            if self.open == self.most:
                fullest = (self.bits & -self.bits).bit_length() - 1
                if fullest <= left:
                    self._take(fullest)
                else:              # the new bin is the fullest itself
                    return bin_, self.capacity - space
            self.free[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
        return bin_, self.capacity - space

    def rest(self) -> list[tuple[int, int]]:
        """(bin, used) of the bins still open."""
        return sorted((b, self.capacity - f) for f, bins in enumerate(self.free) for b in bins)


def _pack_rows(tokenizer_json: str, by_word: bool, end_id: int, capacity: int, open_bins: int, id_type):
    def run(batches):
        encoder, packer = Encoder(tokenizer_json, by_word), BestFit(capacity, open_bins)
        end = np.array([end_id], dtype="<u4").tobytes()
        first = TaskContext.get().partitionId() << 32

        def table(ids, rows, values, is_open):
            piece, start, length, bin_, offset = np.array(rows, dtype=np.int64).reshape(-1, 5).T
            return pa.RecordBatch.from_arrays(
                [ids, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                 pa.array(values, pa.binary()),
                 pa.array(bin_ + first), pa.array(offset), pa.array(np.full(len(piece), is_open))],
                ["doc_id", "piece", "start", "length", "ids", "bin", "offset", "is_open"])

        def packed(ids, held):
            bins = [(0, 0)] * len(held)
            for k in sorted(range(len(held)), key=lambda k: -held[k][3]):
                bins[k] = packer.put(held[k][3])
            rows = [(piece, start, length, *at) for (_, piece, start, length, _), at in zip(held, bins)]
            return table(ids.take(pa.array([h[0] for h in held])), rows, [h[4] for h in held], False)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            held, n_held = [], 0
            for n in range(len(texts)):
                data = encoder.encode(texts[n].as_py() or "") + end
                total = len(data) // 4
                for piece, start in enumerate(range(0, total, capacity)):
                    length = min(capacity, total - start)
                    held.append((n, piece, start, length, data[4 * start:4 * (start + length)]))
                    n_held += length
                    if n_held >= HELD_IDS:
                        yield packed(ids, held)
                        held, n_held = [], 0
            if held:
                yield packed(ids, held)
        rest = packer.rest()
        if rest:
            yield table(pa.nulls(len(rest), id_type), [(0, 0, used, b, 0) for b, used in rest], [None] * len(rest), True)
    return run


def _merge(capacity: int, open_bins: int):
    """Bins of a group packed as wholes into the first bin of each new one."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["used", "bin"], ascending=[False, True])
        packer, head, used, out = BestFit(capacity, open_bins), {}, {}, []
        for b, n in zip(pdf["bin"].tolist(), pdf["used"].tolist()):
            to, offset = packer.put(n)
            out.append((b, head.setdefault(to, b), offset))
        still = {head[to]: n for to, n in packer.rest()}
        return pd.DataFrame({"bin": [b for b, _, _ in out], "into": [i for _, i, _ in out], "base": [o for _, _, o in out],
                             "used": [still.get(b, 0) if b == i else 0 for b, i, _ in out]})
    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         open_bins: int = OPEN_BINS, end_id: int = END_ID, by_word: bool = True) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, sequence_id,
    offset``; ``tokenizer`` is the path of a vocabulary file on the driver. ``ids``
    are little-endian unsigned 32-bit numbers in one binary value, which Spark
    copies as it is and ``numpy.frombuffer(ids, "<u4")`` reads.

    A null or empty text is its end id alone. Rows that repeat an id are
    documents of their own; ids may be null. Other columns are ignored, whatever
    their names; an empty table gives no rows. Special tokens spelled out in a
    text become their ids, as ``tokenizers`` does by default.
    """
    text = Path(tokenizer).read_text(encoding="utf-8")
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    packed = rows.mapInArrow(
        _pack_rows(text, by_word, end_id, capacity, open_bins, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, piece int, start long, length long, ids binary, bin long, offset long, is_open boolean")
    packed = staged(packed, "packed")
    pieces = packed.filter("not is_open")
    rest = packed.filter("is_open").select("bin", F.col("length").alias("used"), F.shiftright("bin", 32).alias("part"))
    moves, shift = None, 1
    while True:
        groups = rest.agg(F.countDistinct(F.floor(F.col("part") / shift))).first()[0]
        if groups == 0 or (moves is not None and groups == 1):
            break
        shift *= FAN_IN
        step = staged(rest.groupBy(F.floor(F.col("part") / shift).alias("group")).applyInPandas(
            lambda pdf: _merge(capacity, open_bins)(pdf), "bin long, into long, base long, used long"), "moves")
        if moves is None:
            moves = step.select("bin", "into", "base")
        else:
            later = small(step.select(F.col("bin").alias("bin_"), F.col("into").alias("into_"), F.col("base").alias("base_")))
            moves = staged(moves.join(later, F.col("into") == F.col("bin_"), "left").select(
                "bin", F.coalesce("into_", "into").alias("into"), (F.col("base") + F.coalesce("base_", F.lit(0))).alias("base")), "moves")
        rest = step.filter("used > 0").select("bin", "used", F.shiftright("bin", 32).alias("part"))
    out = pieces
    if moves is None:
        return pieces.select("doc_id", "piece", "start", "length", "ids", F.col("bin").alias("sequence_id"), "offset")
    moves = small(moves.filter("bin <> into or base > 0").withColumnRenamed("bin", "moved"))
    return out.join(moves, F.col("bin") == F.col("moved"), "left").select(
        "doc_id", "piece", "start", "length", "ids", F.coalesce("into", "bin").alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids, doc_ids, offsets``;
    one sequence at most (``capacity`` ids) is gathered in a place."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.unhex(F.array_join(F.transform("p.ids", F.hex), "")).alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))

