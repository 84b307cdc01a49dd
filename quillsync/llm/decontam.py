"""Benchmark decontamination by templates: catches re-parameterised questions.

Native: DataFrame and SQL functions only.

A text's words (split at white space, outer punctuation removed) become a
template: numbers ``<num>``, numbers with a unit attached ``<qty>``, unit words
after a number ``<unit>``, capitalised words ``<name>`` wherever they stand, all
other words lower case.  Windows of ``WINDOW`` template words of every document are
hash-joined to those of the benchmark, and beside them windows of its literal
words in lower case, so neither a changed name nor changed case hides a match.
Matches of one document and item at one shift form an alignment; it is kept when
it covers half of the item's windows of either kind, or ``RUN`` of both together.
Slots are compared at the places of matched windows: a value that the item
repeats there must have one value in the document wherever both sides have a slot
of the same type.  Where it has several, the windows over them (of names: over
the changed ones) do not count, and the alignment is kept when the others are
enough and at least half of those matched.

Template windows in which less than half of the words are ordinary are not used,
as they would match by shape alone; literal windows are all used.  Items that are
equal as templates and in their words are reported under the smallest item_id.  Items with fewer than
``WINDOW`` words are matched by their literal words at any place of a document
(an item of one word: by that word), and by template with documents that are
equal to them as a whole.

Null text, null doc_id or null item_id: no match.  Documents that share a
doc_id are reported under it once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsync.session import scratch_dir

WINDOW = 8
RUN = 6                       # windows at one shift: 13 words
BROADCAST_WINDOWS = 1_000_000  # 16 bytes each; beyond it the join shuffles

BROADCAST_DOCS = 1_000_000     # 16 bytes each; beyond it the join shuffles

# unit words: fixed values
UNITS = ("mm cm m km in inch inches ft foot feet yard yards mile miles g kg mg lb lbs pound pounds ounce "
         "ounces ton tons l ml liter liters litre litres gallon gallons s sec second seconds min minute "
         "minutes h hr hour hours day days week weeks month months year years percent dollar dollars euro "
         "euros cent cents degree degrees meter meters metre metres kilometer kilometers").split()
_NUMBER = "^[+-]?[0-9][0-9.,:/]*$"
_QUANTITY = "^[+-]?[0-9][0-9.,:/]*(%|[a-z]{1,3})$"
_NUMERIC = "^[+-]?[0-9]"
_NAME = "^\\p{Lu}[\\p{L}\\p{M}'’.-]*$"
_POSSESSIVE = "['’]s$"
# one word, its outer punctuation left out of the group; no part of it is tried twice
_WORD = ("(?=[^ \\t-\\r])[^\\p{L}\\p{N}+\\- \\t-\\r]*+((?:[^ \\t-\\r]*[\\p{L}\\p{N}%])?)[^ \\t-\\r]*+")


def _barrier(df: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """Adds columns that are computed once per row, however often they are used
    (a generator over one struct, which the optimizer does not fold away)."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in made.items()]))))


def _templates(df: DataFrame, key: str) -> DataFrame:
    """(key, word, tpl): the words, in lower case, and template words of each row of (key, text)."""
    # the words are cut in one pass over the text, not by a regex for each
    word = _barrier(df.where(F.col(key).isNotNull() & F.col("text").isNotNull()), [key],
                    word=F.regexp_extract_all("text", F.lit(_WORD), 1))
    word = _barrier(word, [key, "word"], low=F.transform("word", F.lower))

    def template(x, i):
        before = F.get("word", i - 1)
        low = F.get("low", i)
        unit = low.isin(UNITS) & F.coalesce(before.rlike(_NUMBER), F.lit(False))
        # most words begin with a-z: neither numbers nor names, whatever follows
        return (F.when(F.ascii(x).between(97, 122), F.when(unit, "<unit>").otherwise(low))
                .when(x.rlike(_NUMERIC), F.when(x.rlike(_NUMBER), "<num>").when(x.rlike(_QUANTITY), "<qty>")
                      .otherwise(low))
                .when(unit, "<unit>")
                .when(x.rlike(_NAME), "<name>")
                .otherwise(low))

    return _barrier(word, [key, "low"], tpl=F.transform("word", template)).withColumnRenamed("low", "word")


def _windows(words: str, width: int) -> Column:
    """Hashes of every window of the words; none where they are fewer than a window."""
    n = F.size(words)
    return F.when(n >= width, F.transform(
        F.sequence(F.lit(0), n - width), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))) \
        .otherwise(F.array().cast("array<bigint>"))


def _doubled(df: DataFrame, keep: list[str], **words: str) -> DataFrame:
    """``keep`` and, for each named column of words, hashes of every window of WINDOW of them: of pairs,
    of pairs of pairs and so on, so that a place takes one look-up a step; none where the
    words are fewer than a window."""
    def joined(column: str, width: int) -> Column:
        return F.transform(column, lambda x, i: F.xxhash64(x, F.get(column, i + width)))

    names = list(words)
    step, width = dict(words), 1
    while width < WINDOW:
        made = {k: joined(step[k], width) for k in names}
        rest = [c for c in keep if c not in made]
        width *= 2
        if width == WINDOW:
            # windows that reach past the end are no windows
            made = {k: F.slice(made[k], 1, F.greatest(F.size(step[k]) - (WINDOW - 1), F.lit(0))) for k in names}
        df = _barrier(df, rest, **{f"{k}_{width}": c for k, c in made.items()})
        step = {k: f"{k}_{width}" for k in names}
    return df.select(*keep, *[F.col(step[k]).alias(k) for k in names])


def _whole(words: str) -> Column:
    """The hash of a whole template that is shorter than a window; of others, none."""
    return F.when(F.size(words).between(1, WINDOW - 1), F.xxhash64(words, F.lit(0)))


def _is_slot(x: Column) -> Column:
    return x.isin("<num>", "<qty>", "<unit>", "<name>")


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"),
                             F.col(text_col).cast("string").alias("text"))
    return _templates(items, "item_id").groupBy("word", "tpl").agg(F.min("item_id").alias("item_id"))


def _item_windows(items: DataFrame) -> DataFrame:
    """(h, item_id, at, typed, n, n_typed): windows of the items, by template (typed) and
    by literal words; an item has n places of windows and n_typed usable templates."""
    n = F.size("tpl")
    made = _doubled(items, ["item_id", "word", "tpl"], typed="tpl", literal="word")
    whole = F.coalesce(F.array(_whole("tpl")), F.array())
    typed = made.where(n > 0).select(
        "item_id", "tpl", F.posexplode(F.when(n < WINDOW, whole).otherwise(F.col("typed"))).alias("at", "h")) \
        .where(F.size(F.filter(F.slice("tpl", F.col("at") + 1, WINDOW), _is_slot)) * 2
               <= F.least(F.lit(WINDOW), n)) \
        .select("item_id", "at", "h", F.lit(True).alias("typed"))
    short = F.when(F.size("word").between(1, WINDOW - 1), F.array(F.xxhash64("word"))).otherwise(F.col("literal"))
    literal = made.select("item_id", F.posexplode(short).alias("at", "h")) \
        .select("item_id", "at", "h", F.lit(False).alias("typed"))
    w = typed.unionByName(literal)
    total = w.groupBy("item_id").agg(F.count_distinct("at").alias("n"),
                                     F.sum(F.col("typed").cast("long")).alias("n_typed"))
    return w.join(total, "item_id").select("h", "item_id", "at", "typed", "n", "n_typed")


def _doc_windows(templates: DataFrame, key: str, widths: list[int]) -> DataFrame:
    """(key, place, h): both kinds of windows of the documents, and literal ones of the
    widths of short items."""
    made = _doubled(templates, [key, "word", "tpl"], typed="tpl", literal="word")
    made = _barrier(made, [key, "typed", "literal"], whole=_whole("tpl"),
                    **{f"w{k}": _windows("word", k) for k in widths})
    # one array of numbers: the whole of a short text, templates, literal windows (where the two are equal,
    # one is enough), short ones; with the ends of the parts, as the arrays themselves
    # must not be carried along with every window
    parts = {"whole": F.filter(F.array("whole"), lambda h: h.isNotNull()), "typed": F.col("typed"),
             "literal": F.transform("literal", lambda h, i: F.nullif(h, F.get("typed", i))),
             **{f"w{k}": F.col(f"w{k}") for k in widths}}
    ends, end = {}, F.lit(0)
    for k in list(parts)[:-1]:
        end = end + (F.when(F.col("whole").isNotNull(), 1).otherwise(0) if k == "whole" else F.size(k))
        ends[f"end_{k}"] = end
    made = _barrier(made, [key], hs=F.concat(*parts.values()), **ends)
    place = F.col("pos")
    for k in ends:
        place = F.when(F.col("pos") >= F.col(k), F.col("pos") - F.col(k)).otherwise(place)
    return made.select(key, *ends, F.posexplode("hs").alias("pos", "h")) \
        .where(F.col("h").isNotNull()).select(key, place.alias("place"), "h")


def _slots(templates: DataFrame, key: str) -> DataFrame:
    """(key, place, kind, value) of every placeholder."""
    return templates.select(key, F.posexplode(F.arrays_zip("tpl", "word")).alias("place", "x")) \
        .where(_is_slot(F.col("x.tpl"))) \
        .select(key, "place", F.col("x.tpl").alias("kind"), F.regexp_replace("x.word", _POSSESSIVE, "").alias("value"))


def _enough(typed: str | Column, literal: str | Column) -> Column:
    """Whether the places of matched windows are half of the item's, or ``RUN`` of them."""
    hits = F.size(F.array_union(typed, literal))
    return (hits * 2 >= F.col("n")) | ((F.col("n_typed") > 0) & (F.size(typed) * 2 >= F.col("n_typed"))) | (hits >= RUN)


def _covered(place: str, ats: str) -> Column:
    """Whether a window that starts at one of the places has the place in it."""
    return F.exists(ats, lambda a: F.col(place).between(a, a + (WINDOW - 1)))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_windows, item_windows, n_slots, changed_slots): one row for
    each document and item it holds, for the best alignment of the two."""
    text = F.col(text_col).cast("string")
    # rows that share a doc_id but not their text are told apart until the end
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.struct(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text")).alias("doc"),
        text.alias("text"))
    items = _items(benchmark, item_col, item_text)
    known = _item_windows(items)
    if known.count() <= BROADCAST_WINDOWS:
        known = F.broadcast(known)
    n = F.size("word")
    widths = sorted(r.n for r in items.where(n.between(1, WINDOW - 1)).select(n.alias("n")).distinct().collect())
    own = _doc_windows(_templates(rows, "doc"), "doc", widths)
    shifts = own.join(known, "h") \
        .groupBy("doc", "item_id", (F.col("place") - F.col("at")).alias("shift"), "n", "n_typed") \
        .agg(F.collect_set(F.when(F.col("typed"), F.col("at"))).alias("typed"),
             F.collect_set(F.when(~F.col("typed"), F.col("at"))).alias("literal")) \
        .where(_enough("typed", "literal")) \
        .withColumn("hits", F.size(F.array_union("typed", "literal")).cast("long"))
    # written, as only the documents with an alignment are read again for their slots
    path = scratch_dir(docs.sparkSession, f"decontam-{uuid.uuid4().hex}")
    shifts.write.parquet(path)
    shifts = docs.sparkSession.read.parquet(path)
    hit = shifts.select("doc").distinct()
    if hit.count() <= BROADCAST_DOCS:
        hit = F.broadcast(hit)
    rows = rows.join(hit, "doc", "left_semi")
    asked = shifts.select("doc", "item_id", "shift", F.array_union("typed", "literal").alias("ats")) \
        .join(_slots(items, "item_id"), "item_id").where(_covered("place", "ats")) \
        .select("doc", "item_id", "kind", "value", "shift", F.col("place").alias("at"),
                (F.col("place") + F.col("shift")).alias("place"))
    odd = F.col("here") != F.col("value")
    found = asked.join(_slots(_templates(rows, "doc"), "doc").withColumnRenamed("value", "here"),
                       ["doc", "place", "kind"]) \
        .groupBy("doc", "item_id", "shift", "kind", "value") \
        .agg((F.min("here") != F.max("here")).alias("broken"), F.max(odd).alias("changed"),
             F.collect_list(F.when((F.col("kind") != "<name>") | odd, F.col("at"))).alias("at")) \
        .groupBy("doc", "item_id", "shift") \
        .agg(F.count("*").alias("n_slots"), F.sum(F.col("changed").cast("long")).alias("changed"),
             F.flatten(F.collect_list(F.when(F.col("broken"), F.col("at")))).alias("bad"))

    def left(places: str) -> Column:
        return F.filter(places, lambda a: ~F.exists(
            F.coalesce("bad", F.array().cast("array<int>")), lambda b: b.between(a, a + (WINDOW - 1))))

    return shifts.join(found, ["doc", "item_id", "shift"], "left") \
        .withColumns({"typed": left("typed"), "literal": left("literal")}) \
        .withColumns({"before": F.col("hits"), "hits": F.size(F.array_union("typed", "literal")).cast("long")}) \
        .where(_enough("typed", "literal") & (F.col("hits") * 2 >= F.col("before"))) \
        .groupBy(F.col("doc.id").alias("doc_id"), "item_id") \
        .agg(F.max(F.struct("hits", F.col("n").alias("of"), F.coalesce("n_slots", F.lit(0)).alias("n_slots"),
                            F.coalesce("changed", F.lit(0)).alias("changed"))).alias("best")) \
        .select("doc_id", "item_id", F.col("best.hits").alias("n_windows"), F.col("best.of").alias("item_windows"),
                F.col("best.n_slots").cast("long").alias("n_slots"),
                F.col("best.changed").cast("long").alias("changed_slots"))
