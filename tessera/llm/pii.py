"""Personal data: pattern spans and information-theoretic sanitisation.

Base spans are what the patterns find. Around them the corpus tells which
ordinary words give a protected entity (one e-mail address, one phone number
...) away: with the words near an entity as context, the disclosure of entity e
by term t is

    PMI(e; t) / IC(e) = log(N n_et / (n_e n_t)) / log(N / n_e)

over documents: 1 if t occurs only beside e (knowing t is knowing e), 0 if t
says nothing about it. Every pair is scored. One seen in fewer than ``support``
different contexts (copies of one passage are one context) counts with a lower
bound: with c contexts as c independent sightings, P(e | t) is n_et / n_t times
CHANCE ** (1 / c), the one-sided bound after c hits of c, so PMI is less by
-log(CHANCE) / c. A term is generalised to its shape from ``generalise_at`` on
and removed from ``remove_at`` on, wherever it occurs.

Scale. Contexts are folded before they are counted; pairs are as many as the
words beside entities, and only terms that disclose something are looked for in
the texts. What a text contains is keyed by the
text's hash, so copies share one row; texts meet it by a join that Spark may
broadcast or split by its real size. All of it is built-in expressions, grouped
counts and joins; the list of terms is broadcast only after its size is checked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import col, fresh, small, staged

KINDS = ("email", "ip", "card", "phone", "term")

# The patterns, as given; without a way to go back where going back cannot
# help, so that long runs take linear time. A search starts at the beginning of
# a run of its first class or where the last match ended.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WORD = r"[\p{L}\p{N}_]+"
REACH = 120  # characters of context on either side
SPAN = "struct<start:int,kind:int,end:int>"
PART, BLOCK = 128, 1024  # elements a part of a fold, characters a block
CHANCE = 0.05  # of the true share of a rarely seen pair being below its bound


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether 12 to 19 digits pass the Luhn check."""
    def weigh(d, i):
        n = d.cast("int")
        twice = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return F.when(i % 2 == 1, twice).otherwise(n)
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(d != "", weigh(d, i)).otherwise(0))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _passes(kind: int, match: Column) -> Column:
    if kind == 1:
        return F.forall(F.split(match, r"\."), lambda p: p.rlike("^0*([0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    if kind == 2:
        digits = _digits(match)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == 3:
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, though lambdas in it read it often."""
    return F.transform(F.array(value), then)[0]


def _parts(items: Column) -> Column:
    last = F.floor((F.size(items) - 1) / PART).cast("int")
    return F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(items, k * PART + 1, F.lit(PART)))).otherwise(
        F.slice(F.array(items), 1, 0))


def _fold(items: Column, at, kind: str, step) -> Column:
    """The values, of type ``kind``, that a fold over ``items`` gives out:
    ``step(at, item)`` is the next state, the value and whether there is one. Values are
    gathered by parts, as appending to one array copies all of it each time."""
    none = F.array().cast(f"array<{kind}>")

    def one(state, x):
        after, value, there = step(state["at"], x)
        return F.struct(after.alias("at"), F.when(there, F.array_append(state["out"], value)).otherwise(state["out"]).alias("out"))

    def part(state, xs):
        within = F.aggregate(xs, F.struct(state["at"].alias("at"), none.alias("out")), one)
        return _let(within, lambda w: F.struct(w["at"].alias("at"), F.array_append(state["out"], w["out"]).alias("out")))

    begin = F.struct(F.lit(at).alias("at"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return _let(items, lambda xs: F.aggregate(_parts(xs), begin, part, lambda s: F.flatten(s["out"])))


def _blocks(text: Column) -> Column:
    """The text in pieces of BLOCK characters, so that a place far in is found at once."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def _cut(blocks: Column, start: Column, end: Column) -> Column:
    """Characters ``start`` to ``end`` (exclusive) of a text given by its blocks."""
    first = F.floor(start / BLOCK).cast("int")
    several = F.floor((end - 1) / BLOCK).cast("int") - first + 1
    return F.when(end > start, F.substring(F.array_join(F.slice(blocks, first + 1, several), ""), start - first * BLOCK + 1, end - start)).otherwise("")


def _spans(text: Column, pattern: str | Column, kind: int, keep) -> Column:
    """Spans ``(start, kind, end)`` of the matches that ``keep`` accepts. A
    match starts after the pieces between matches and the matches before it."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                         F.regexp_extract_all(text, pattern, F.lit(0)).alias("match"))

    def step(at, x):
        start = at + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        return end, F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end")), x["match"].isNotNull() & keep(x["match"])

    return _fold(found, 0, SPAN, step)


def base_spans(text: Column) -> Column:
    """Pattern spans of a text, by start, then kind."""
    none = F.array().cast(f"array<{SPAN}>")
    needs = ("[@]", "[0-9]", "[0-9]", "[+]")
    parts = [F.when(text.rlike(need), _spans(text, p, k, lambda m, k=k: _passes(k, m))).otherwise(none)
             for k, (p, need) in enumerate(zip(PATTERNS, needs))]
    return F.array_sort(F.concat(*parts))


def _near(blocks: Column, span: Column) -> Column:
    """Lower-cased words within reach of a span; words cut by the reach are
    left out."""
    start, end = span["start"], span["end"]
    # one character more than the reach tells whether its edge cuts a word
    left = _cut(blocks, F.greatest(start - REACH - 1, F.lit(0)), start)
    left = F.when(start > REACH, F.regexp_replace(left, rf"(?s)^(?:{WORD}|.)", "")).otherwise(left)
    right = _cut(blocks, end, end + REACH + 1)
    right = F.when(F.length(right) > REACH, F.regexp_replace(right, rf"(?s)(?:{WORD}|.)\z", "")).otherwise(right)
    words = F.regexp_extract_all(F.lower(F.concat(left, F.lit(" "), right)), F.lit(WORD), F.lit(0))
    return F.filter(F.array_distinct(words), _a_term)


def _a_term(word: Column) -> Column:
    """Numbers and short words count too, but for one or two Latin letters."""
    return (F.length(word) >= 3) | ~word.rlike(r"^[\p{IsLatin}_]+$")


def disclosing_terms(texts: DataFrame, support: int = 2, generalise_at: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """``(terms, marks)`` for a table of one column ``text``: ``terms(term,
    disclosure)`` from ``generalise_at`` on (the largest over all entities), and
    ``marks(text_key, terms)`` for the texts that have some."""
    def seen(blocks, span):
        kind = F.element_at(F.array(*map(F.lit, KINDS)), span["kind"] + 1)
        entity = F.concat_ws(":", kind, _cut(blocks, span["start"], span["end"]))
        return F.struct(entity.alias("entity"), F.array_sort(_near(blocks, span)).alias("words"))

    spotted = texts.filter(F.col("text").rlike("[0-9@]")).select(F.explode(_let(_blocks(F.col("text")), lambda blocks: F.transform(
        base_spans(F.col("text")), lambda span: seen(blocks, span)))).alias("seen")).select("seen.*")
    contexts = spotted.groupBy("entity", "words").agg(F.count("*").alias("docs"))
    contexts = staged(contexts, "contexts")
    entities = contexts.groupBy("entity").agg(F.sum("docs").alias("n_e"))
    pairs = contexts.select("entity", "docs", F.explode("words").alias("term")).groupBy("entity", "term").agg(
        F.sum("docs").alias("n_et"), F.count("*").alias("contexts"))
    pairs = staged(pairs, "pairs")

    # how many documents hold each word: counted per task first, so a word
    # costs a row per task, not one per document
    words = F.filter(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lower)), _a_term)
    words = texts.select(F.xxhash64("text").alias("text_key"), F.explode(words).alias("term"))
    n_t = words.groupBy("term").agg(F.count("*").alias("n_t"))
    total = F.lit(float(texts.count()))
    scored = pairs.join(n_t, "term").join(entities, "entity")
    ic = F.log(total / F.col("n_e"))
    pmi = F.log(total * F.col("n_et") / (F.col("n_e") * F.col("n_t")))
    pmi = F.when(F.col("contexts") >= support, pmi).otherwise(pmi + math.log(CHANCE) / F.col("contexts"))
    terms = scored.filter(F.col("n_e") < total).groupBy("term").agg(F.max(F.least(pmi / ic, F.lit(1.0))).alias("disclosure"))
    terms = staged(terms.filter(F.col("disclosure") >= generalise_at), "terms")
    marks = words.join(small(terms), "term").dropDuplicates(["text_key", "term"]).groupBy("text_key").agg(
        F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("terms"))
    return terms, marks


def find(df: DataFrame, text_col: str = "text", support: int = 2, generalise_at: float = 0.5,
         remove_at: float = 0.9) -> DataFrame:
    """``df`` with ``base`` and ``spans`` (arrays of ``(start, kind, end)`` in
    code points, kind an index of ``KINDS``) and ``sanitised``, the text with
    pattern spans replaced by their kind and terms removed or generalised to
    their shape. An underscore is added to a name that is taken.

    Null texts count as empty; texts without findings have empty arrays and
    come back unchanged (null as empty). Terms inside a pattern span are not
    spans of their own. Rows that repeat are counted as documents of their own.
    """
    base, spans, out, key, marks_of, text = fresh(df, "base", "spans", "sanitised", "text_key", "marks", "whole")
    texts = df.select(F.coalesce(col(text_col), F.lit("")).alias("text"))
    _, marks = disclosing_terms(texts, support, generalise_at)
    marks = staged(marks, "marks").select(F.col("text_key").alias(key), F.col("terms").alias(marks_of))
    whole = F.coalesce(col(text_col), F.lit(""))
    rows = df.withColumn(text, whole).join(marks, F.xxhash64(whole) == F.col(key), "left").withColumn(base, base_spans(F.col(text)))
    # only whole words that are terms of the text, so that other words cost no step
    listed = F.concat(F.lit(rf"(?iu)(?<!{WORD[:-1]})(?:"), F.array_join(F.map_keys(F.col(marks_of)), "|"), F.lit(rf")(?!{WORD[:-1]})"))
    terms = F.when(F.col(marks_of).isNotNull(), _spans(
        F.col(text), listed, 4, lambda w: F.map_contains_key(F.col(marks_of), F.lower(w))))
    rows = rows.withColumn(spans, F.when(F.col(marks_of).isNull(), F.col(base)).otherwise(_apart(F.array_sort(F.concat(F.col(base), terms)))))
    rows = rows.withColumn(out, _rewritten(F.col(text), F.col(spans), F.col(marks_of), remove_at))
    return rows.select(*[col(c) for c in df.columns], base, spans, out)


def _apart(spans: Column) -> Column:
    """Sorted spans without the terms that overlap a pattern span: those that start before
    the end of a pattern span at or before them, then, from the end, those that end after
    the start of one behind them."""
    base = lambda s: s["kind"] < 4
    ahead = _fold(spans, 0, SPAN, lambda at, s: (
        F.when(base(s), F.greatest(at, s["end"])).otherwise(at), s, base(s) | (s["start"] >= at)))
    back = _fold(F.reverse(ahead), 2 ** 31 - 1, SPAN, lambda at, s: (
        F.when(base(s), F.least(at, s["start"])).otherwise(at), s, base(s) | (s["end"] <= at)))
    return F.reverse(back)


def _rewritten(text: Column, spans: Column, marks: Column, remove_at: float) -> Column:
    """The text with its spans replaced; a span that overlaps an earlier one
    goes, and the text goes on after the longer of them."""
    def piece(blocks, at, s):
        word = _cut(blocks, s["start"], s["end"])
        shape = F.regexp_replace(F.regexp_replace(word, r"\p{L}+", "x"), r"\p{N}+", "0")
        name = F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]"))
        put = F.when(s["kind"] < 4, name).when(F.element_at(marks, F.lower(word)) >= remove_at, "").otherwise(shape)
        return F.concat(_cut(blocks, at, s["start"]), put)

    pieces = _let(_blocks(text), lambda blocks: _fold(spans, 0, "string", lambda at, s: (
        F.greatest(at, s["end"]), piece(blocks, at, s), s["start"] >= at)))
    end = F.array_max(F.transform(spans, lambda s: s["end"]))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(F.array_join(pieces, ""), F.substring(text, end + 1, F.length(text))))


def count_kind(spans: Column, kind: int) -> Column:
    """How many spans are of a kind. (A second parameter of the lambda would be the
    element's place.)"""
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def spelled(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")
