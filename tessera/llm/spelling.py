"""Spelling variants by PartEnum signatures.

A word's letter multiset is a binary vector with one place per (letter, how
manyth). One inserted or deleted letter changes one place, one replaced letter
two, so words one edit apart have vectors at Hamming distance two at most.
PartEnum: the places are dealt by hash to ``PARTS`` parts, and a vector gets one
signature for every choice of two parts, made of all the others. Two vectors that
differ in two places at most agree on the signature that leaves out the parts
of those places; so an equi-join on signatures finds every such pair. A
signature is the XOR of its places' hashes, so all 28 come from one pass over the
letters. Vectors of different size classes and pairs seen in another signature are
cut in the join; what is left is verified on the words themselves.

Scale. Counting is one pass over the texts with map-side combine; only
words go on. Words with equal multisets (anagrams, which are never one edit apart)
share one vector. A signature held by more than ``crowd`` vectors is enumerated
once more, with every place in a part of its own: the signature and the signature
without one place of the parts left out. At most one vector per letter, and one
more, share those, so no key joins more than ``crowd`` rows and nothing is
capped. Pairs of vectors meet their words in two joins; the second keeps pairs
one edit apart only. Roots come by pointer doubling, each round written.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, small, staged

PARTS = 8
PAIRS = list(combinations(range(PARTS), 2))
CROWD = 64      # vectors that share a signature before it is split
PIECE = 1000    # vectors enumerated at once in a task
LETTERS = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _without(word: Column, place: Column) -> Column:
    """``word`` without its code point at ``place`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.char_length(word)))


def words(docs: DataFrame, id_col: str, text_col: str, least: int, shortest: int) -> DataFrame:
    """``word, n`` of all runs of letters, after the deletions that the row id
    decides."""
    runs = docs.select(F.coalesce(col(id_col).cast("string"), F.lit("")).alias("of"),
                       F.explode(F.regexp_extract_all(col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    runs = runs.select("of", F.when(F.octet_length("run") == F.char_length("run"), F.lower("run")).otherwise(
        F.translate("run", UPPER, UPPER.lower())).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("of", F.lit(":"), "run").cast("binary")).alias("h"))
    place = (F.col("h") % F.char_length("run")).cast("int")
    out = runs.select(F.when(F.col("h") % 97 == 0, _without(F.col("run"), place)).otherwise(F.col("run")).alias("word"))
    return out.filter(F.char_length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least)


def _place(letter: str, nth: int) -> tuple[int, int]:
    """(part, 64-bit hash) of a place."""
    h = int.from_bytes(hashlib.blake2b(f"{letter}{nth}".encode(), digest_size=9).digest(), "little")
    return (h & 255) % PARTS, (h >> 8) - (1 << 63)


class _Places(dict):
    def __missing__(self, key):
        out = _place(*key)
        if len(self) < 65536:
            self[key] = out
        return out


def _vector(letters: str, places: _Places) -> tuple[list[int], dict[str, int]]:
    """(XOR of the places' hashes by part, letters with their counts)."""
    parts, count = [0] * PARTS, {}
    for c in letters:
        count[c] = nth = count.get(c, 0) + 1
        part, h = places[c, nth]
        parts[part] ^= h
    return parts, count


def _vectors(letters: list[str], places: _Places) -> tuple[np.ndarray, list[dict[str, int]]]:
    """(the words' XORs by part, one row a word; their letters with counts)."""
    found = [_vector(x, places) for x in letters]
    return np.array([parts for parts, _ in found], dtype=np.int64).reshape(-1, PARTS), [count for _, count in found]


def _enumerate(batches):
    """Every vector's signatures, with the hashes of the two parts left out."""
    places = _Places()
    first, second = np.array(PAIRS).T
    for some in _pieces(batches):
        parts, _ = _vectors(some["letters"].tolist(), places)
        one, two = parts[:, first], parts[:, second]
        whole = np.bitwise_xor.reduce(parts, axis=1)[:, None]
        yield pd.DataFrame({"pair": np.tile(np.arange(len(PAIRS), dtype=np.int32), len(parts)), "signature": (whole ^ one ^ two).ravel(),
                            "first": one.ravel(), "second": two.ravel(), "letters": np.repeat(some["letters"].to_numpy(), len(PAIRS))})


def _split(batches):
    """A crowded signature's vectors by the signature itself and by every
    signature that leaves out one more place of the two parts."""
    places = _Places()
    for some in _pieces(batches):
        parts, counts = _vectors(some["letters"].tolist(), places)
        whole = np.bitwise_xor.reduce(parts, axis=1).tolist()
        signatures = []
        for pair, w, count in zip(some["pair"].tolist(), whole, counts):
            inside = [h for part, h in (places[c, n] for c, n in count.items()) if part in PAIRS[pair]]
            signatures.append([w, *[w ^ h for h in inside]])
        rows = some.loc[np.repeat(some.index.to_numpy(), [len(s) for s in signatures])]
        yield rows.assign(signature=np.array([s for own in signatures for s in own], dtype=np.int64))


def _pieces(batches):
    """Batches in pieces of ``PIECE`` rows, each of which becomes some 28."""
    for pdf in batches:
        for start in range(0, len(pdf), PIECE):
            yield pdf.iloc[start:start + PIECE].reset_index(drop=True)


_ROW = "pair int, signature long, first long, second long, letters string"


def _meet(rows: DataFrame) -> DataFrame:
    """Pairs of vectors with equal signatures, sizes one apart at most, each in
    one of its common signatures only, sorted letters two edits apart at most."""
    a, b = rows.alias("a"), rows.alias("b")
    first, second = F.col("a.first") != F.col("b.first"), F.col("a.second") != F.col("b.second")
    # differing in one part only: the signature that leaves out that part and
    # part 0 (parts 0 and 1 for part 0) has the pair
    with_0 = F.col("a.pair") < PARTS - 1
    here = (first & second) | (first & ~second & (F.col("a.pair") == 0)) | (~first & second & with_0)
    apart = F.abs(F.char_length("a.letters") - F.char_length("b.letters"))
    near = F.levenshtein(F.col("a.letters"), F.col("b.letters"), 2)
    return a.join(b, (F.col("a.pair") == F.col("b.pair")) & (F.col("a.signature") == F.col("b.signature")) & (
        F.col("a.letters") < F.col("b.letters")) & (apart <= 1) & here & near.between(0, 2)).select(
            F.col("a.letters").alias("one"), F.col("b.letters").alias("two"))


def near_vectors(vectors: DataFrame, crowd: int = CROWD) -> DataFrame:
    """Pairs ``one, two`` of distinct sorted letter strings whose multisets are
    at Hamming distance two at most (and a few further apart)."""
    rows = staged(vectors.select("letters").mapInPandas(_enumerate, _ROW), "signatures")
    crowded = staged(rows.groupBy("pair", "signature").count().filter(F.col("count") > crowd).select(
        F.col("pair").alias("p"), F.col("signature").alias("s")), "crowded")
    match = (F.col("pair") == F.col("p")) & (F.col("signature") == F.col("s"))
    calm = rows.join(small(crowded), match, "left_anti")
    finer = rows.join(small(crowded), match, "left_semi").mapInPandas(_split, _ROW)
    return _meet(calm).unionByName(_meet(staged(finer, "finer")))


def near_words(counted: DataFrame, crowd: int = CROWD) -> DataFrame:
    """``word, n, other, other_n``: all pairs one edit apart, both ways."""
    known = staged(counted.withColumn("letters", F.array_join(F.array_sort(F.split("word", "")), "")), "spelling-words")
    pairs = near_vectors(known.select("letters").distinct(), crowd)
    left = known.select(F.col("letters").alias("one"), "word", "n")
    right = known.select(F.col("letters").alias("two"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    met = pairs.join(left, "one").join(right, "two")
    met = staged(met.filter(F.levenshtein("word", "other", 1) == 1).select("word", "n", "other", "other_n"), "near-words")
    return met.unionByName(met.select(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"),
                                      F.col("n").alias("other_n")))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows ``word, form``: the end of the chain of forms. A
    form has twice its word's count at least, so chains end."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = small(now.select(F.col("word").alias("via"), F.col("root").alias("further")))
        now = staged(now.join(step, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("via").isNotNull().alias("moved")), "roots")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 3, shortest: int = 5,
             ratio: int = 2, crowd: int = CROWD) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    Words are the runs of letters with ``shortest`` code points and ``least``
    occurrences; a null text has none, a null id counts as an empty one. Rows that
    repeat count again. ``form`` is the near word with the largest count (ties:
    the smallest word) if it has ``ratio`` times the word's, else null with
    ``form_n``; ``root`` follows the forms. Other columns are ignored, whatever
    their names; an empty table gives no rows.
    """
    counted = staged(words(docs, id_col, text_col, least, shortest), "counted")
    best = near_words(counted, crowd).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    out = counted.join(best.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    fits = F.col("best").isNotNull() & (-F.col("best.less") >= ratio * F.col("n"))
    out = staged(out.select("word", F.when(fits, F.col("best.other")).alias("form"), "n",
                            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                            F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    ends = roots(out.filter("form is not null")).withColumnRenamed("word", "of")
    return out.join(small(ends), F.col("word") == F.col("of"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
