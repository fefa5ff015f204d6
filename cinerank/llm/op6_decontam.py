"""Benchmark decontamination by template canonicalisation.

Numbers (with the sign or currency before them), names and units become typed
placeholders; names are capitalised words, also where they open a sentence unless
they are in a fixed list of words that do (not by the rest of the text, on which an
item's template must not depend).  A-Z is lower-cased and punctuation dropped, so a benchmark
question and its re-parameterised variants have the same template.  Hashes of
all ``n``-word template windows of every whole text are hash-joined with the
windows of the benchmark; a rolling hash built by doubling (1, 2, 4, 8 words ...)
costs a few array passes.  Matches are grouped by document, item and alignment.

Slot check: under one alignment, equal slot values of the item must stand for
equal values in the document (3 apples ... 3 pears may become 7 apples ... 7
pears, not 7 apples ... 9 pears).  Where they do not, the value that most of an item
value's places have (on a tie the unchanged one) counts as its stand-in, and only windows
over other places are rejected.  A document is contaminated by an item when consistent
windows cover ``min_share`` of the item's, or ``enough`` of a long one, or when
neighbouring windows repeat a run of ``literal_run`` words word for word.

Items without a window of their own (fewer than ``n`` words, or too few literals in every
window) are matched whole and word for word, from ``min_literal`` words on: their first words
are hash-joined like a window and the rest is compared.

Everything is DataFrame expressions.  The benchmark's windows are broadcast only
under a size bound, otherwise the join shuffles on the window hash.

Defined results: a null or empty text or item has no window and matches
nothing, like an item of fewer than ``min_literal`` words (no evidence); rows with equal id and text are
reported once; a null id is reported as null; empty tables give an empty table;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cinerank.functions.text import english_stop_words
from cinerank.llm.common import maybe_broadcast, written

#: Placeholders, white space and punctuation.
NUM, UNIT, NAME = "\u0001", "\u0002", "\u0003"
SPACE = r"[\x20\x09-\x0D]+"
PUNCT = ".,;:!?\"'`()[]{}<>*_"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Unit words that are replaced wherever they stand alone or follow digits.
UNITS = (
    "km cm mm kg mg lb lbs oz ml kmh mph kwh hz khz mhz ghz kb mb gb tb "
    "meter meters metre metres kilometer kilometers kilometre kilometres mile miles inch inches foot feet yard yards "
    "gram grams kilogram kilograms pound pounds ounce ounces ton tons tonne tonnes liter liters litre litres gallon gallons "
    "second seconds minute minutes hour hours day days week weeks month months year years "
    "dollar dollars cent cents euro euros percent degree degrees"
).split()
#: Signs and currency that belong to the number they stand before, also inside a token.
SIGNS = r"=+\-\u2212\u2013\u00B1$\u20AC\u00A3\u00A5#~\u2264\u2265\u2248@&^|%"
_DIGITS = r"[0-9]+(?:[.,:/][0-9]+)*"
_NUMBER = rf"(?=[0-9{SIGNS}])(?:(?<![0-9{SIGNS}])([{SIGNS}]+{_DIGITS})|(?<![\p{{L}}\p{{M}}0-9{SIGNS}])({_DIGITS}))"
_UNIT = r"(?i)(?<![\p{L}\p{M}])(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{M}])"
#: Words that are no name when they open a sentence, besides the English stop words.
OPENERS = (
    "after although another assume because before consider calculate compute determine during each every explain "
    "find first given hence however if imagine initially last let many next now one prove second show since "
    "solve some sometimes suppose then therefore thus today two using what when where which while who why write yes"
).split()
_PART = r"[\p{L}\p{M}'-]"
_NAME_INSIDE = r"(?<=[\p{Ll},;] )(\p{Lu}[\p{L}\p{M}'-]+)"
_STOP = "|".join(sorted({*english_stop_words(), *OPENERS}, key=lambda w: (-len(w), w)))
_NAME = rf"(?=\p{{Lu}})(?:{_NAME_INSIDE}|(?<!{_PART})(?=\p{{Lu}}{_PART}*\p{{Ll}})(?!(?i:{_STOP})(?!{_PART}))({_PART}+))"


def annotated(text: Column) -> Column:
    """Tokens with a slot's type before its value (``\\u0001`` + digits and so on)."""
    t = F.translate(text, NUM + UNIT + NAME, "")
    t = F.regexp_replace(t, _NAME, NAME + "$1$2")
    t = F.regexp_replace(t, _NUMBER, " " + NUM + "$1$2")
    t = F.regexp_replace(t, _UNIT, UNIT + "$1")
    return _tokens(t)


def _tokens(t: Column) -> Column:
    t = F.translate(t, UPPER + PUNCT, LOWER)
    return F.filter(F.split(t, SPACE, -1), lambda x: x != "")


def canonical(tokens: Column) -> Column:
    """Template tokens: a token that starts with a slot mark is just the mark."""
    head = lambda x: F.substring(x, 1, 1)
    return F.transform(tokens, lambda x: F.when(head(x).isin(NUM, UNIT, NAME), head(x)).otherwise(x))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def windows(template: Column, n: int) -> Column:
    """Hash of every run of ``n`` template tokens, by doubling."""

    def join(a: Column, la: int, b: Column, lb: int) -> Column:
        """Hashes of runs of la + lb tokens from those of la and lb."""
        size = F.greatest(F.size(a) - lb, F.lit(0))
        return F.zip_with(F.slice(a, F.lit(1), size), F.slice(b, F.lit(la + 1), size), lambda x, y: F.xxhash64(x, y))

    def grow(power: dict[int, Column], k: int) -> Column:
        if 2 * k <= n:
            return _let(join(power[k], k, power[k], k), lambda x: grow({**power, 2 * k: x}, 2 * k))
        return rest(power, power[k], k)

    def rest(power: dict[int, Column], out: Column, length: int) -> Column:
        p = max((p for p in power if p <= n - length), default=0)
        return _let(join(out, length, power[p], p), lambda x: rest(power, x, length + p)) if p else out

    return _let(F.transform(template, lambda x: F.xxhash64(x)), lambda x: grow({1: x}, 1))


def _whole_items(d: DataFrame, b: DataFrame, w: DataFrame, n: int, min_literal: int) -> DataFrame | None:
    """Word-for-word matches (doc_id, text_hash, item_id, item_key, first_word) of the items without a window."""
    size = F.least(F.size("toks"), F.lit(n))
    some = b.where(F.size("toks") >= max(1, min_literal)).join(w.select(F.col("item_id").alias("i_"), F.col("item_key").alias("k_")).distinct(), F.col("item_id").eqNullSafe(F.col("i_")) & (F.col("item_key") == F.col("k_")), "left_anti")
    bare = lambda c: F.transform(c, lambda x: F.translate(x, NUM + UNIT + NAME, ""))
    some = some.select("item_id", "item_key", bare(F.col("toks")).alias("toks"))
    sizes = sorted(r[0] for r in some.select(size).distinct().collect())  # n values at most
    found = None
    for k in sizes:
        mine = some.where(size == k).select("item_id", "item_key", "toks", F.element_at(windows(F.slice("toks", 1, k), k), 1).alias("w"))
        seen = d.select("doc_id", "text_hash", bare(annotated(F.col("text"))).alias("doc_toks")).select("doc_id", "text_hash", "doc_toks", F.posexplode(windows(F.col("doc_toks"), k)).alias("pos", "w"))
        hits = seen.join(maybe_broadcast(mine, 4096), "w").where(F.slice("doc_toks", F.col("pos") + 1, F.size("toks")) == F.col("toks"))
        hits = hits.groupBy("doc_id", "text_hash", "item_id", "item_key").agg(F.min("pos").cast("long").alias("first_word"))
        found = hits if found is None else found.union(hits)
    return found


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 8, min_literal: int = 4, min_share: float = 0.5, enough: int = 40, literal_run: int = 13) -> DataFrame:
    """``doc_id, item_id, n_windows, n_matched, share, first_word, verbatim, text_hash``, one row per document and item."""
    if n < 1 or not 0 < min_share <= 1 or not 0 <= min_literal <= n or literal_run < n:
        raise ValueError("n must be positive, min_share within (0, 1], min_literal within 0..n and literal_run at least n")
    mark = lambda x: F.substring(x, 1, 1).isin(NUM, UNIT, NAME)
    b = benchmark.select("item_id", F.col("text").cast("string").alias("text")).dropDuplicates().withColumn("toks", annotated(F.coalesce("text", F.lit(""))))
    b = b.withColumn("tmpl", canonical("toks"))
    b = written(b.select("item_id", "toks", "tmpl", F.xxhash64("text").alias("item_key")), "items")
    w = b.select("item_id", "item_key", "tmpl", F.posexplode(windows(F.col("tmpl"), n)).alias("item_pos", "w"))
    w = w.where(F.size(F.filter(F.slice("tmpl", F.col("item_pos") + 1, F.lit(n)), lambda x: ~mark(x))) >= min_literal)
    w = written(w.select("item_id", "item_key", "item_pos", "w"), "item_windows")
    n_windows = w.groupBy("item_id", "item_key").agg(F.count(F.lit(1)).alias("n_windows"))

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    d = docs.select("doc_id", text.alias("text")).withColumn("text_hash", F.xxhash64("text"))
    seen = d.select("doc_id", "text_hash", F.posexplode(windows(canonical(annotated(F.col("text"))), n)).alias("pos", "w"))
    hits = seen.join(maybe_broadcast(w, 64), "w").select("doc_id", "text_hash", "item_id", "item_key", (F.col("pos") - F.col("item_pos")).alias("shift"), "item_pos")
    # an alignment holds at most the item's own windows
    runs = hits.groupBy("doc_id", "text_hash", "item_id", "item_key", "shift").agg(F.sort_array(F.collect_set("item_pos")).alias("at"))
    runs = written(runs, "alignments")

    ids = runs.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("th_")).distinct()
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    texts = d.join(maybe_broadcast(ids, 40), same("doc_id", "id_") & (F.col("text_hash") == F.col("th_")), "left_semi").dropDuplicates(["doc_id", "text_hash"])
    texts = texts.select(F.col("doc_id").alias("id_"), F.col("text_hash").alias("th_"), annotated(F.col("text")).alias("doc_toks"))
    r = runs.join(texts, same("doc_id", "id_") & (F.col("text_hash") == F.col("th_")))
    items = b.select(F.col("item_id").alias("it_"), F.col("item_key").alias("ik_"), "toks")
    r = r.join(maybe_broadcast(items, 4096), same("item_id", "it_") & same("item_key", "ik_"))
    r = r.select("*", *_consistent(n)).where("size(at_) > 0")
    # windows that are the same word for word, and the longest run of neighbouring ones
    plain = f"filter(at_, q -> slice(toks, q + 1, {n}) = slice(doc_toks, q + shift + 1, {n}))"
    longest = f"aggregate({plain}, named_struct('last', -2, 'run', 0, 'best', 0), (a, q) -> named_struct('last', q, 'run', if(q = a.last + 1, a.run + 1, 1), 'best', greatest(a.best, if(q = a.last + 1, a.run + 1, 1))), a -> a.best)"
    r = r.withColumn("run", F.expr(longest)).withColumn("same", F.expr(f"size({plain}) = size(at_)")).withColumn("start", F.element_at("at_", 1) + F.col("shift"))
    g = r.select("doc_id", "text_hash", "item_id", "item_key", "same", "start", "run", F.explode("at_").alias("p")).groupBy("doc_id", "text_hash", "item_id", "item_key")
    g = g.agg(F.countDistinct("p").alias("n_matched"), F.min("start").cast("long").alias("first_word"), F.min("same").alias("verbatim"), F.max("run").alias("run"))
    nw = n_windows.select(F.col("item_id").alias("it_"), F.col("item_key").alias("ik_"), "n_windows")
    g = g.join(maybe_broadcast(nw, 48), same("item_id", "it_") & same("item_key", "ik_"))
    g = g.where((F.col("n_matched") >= min_share * F.col("n_windows")) | (F.col("n_matched") >= enough) | (F.col("run") >= literal_run - n + 1))
    g = g.select("doc_id", "item_id", "n_windows", "n_matched", (F.col("n_matched") / F.col("n_windows")).alias("share"), "first_word", "verbatim", "text_hash")
    whole = _whole_items(d, b, w, n, min_literal)
    if whole is None:
        return g
    one = F.lit(1).cast("long")
    return g.union(whole.select("doc_id", "item_id", one, one, F.lit(1.0), "first_word", F.lit(True), "text_hash"))


def _consistent(n: int) -> list[Column]:
    """``at_``: the windows of an alignment that cover no place whose value is not its item value's stand-in."""
    spots = f"filter(sequence(0, size(toks) - 1), p -> substring(toks[p], 1, 1) IN ('{NUM}', '{UNIT}', '{NAME}') AND exists(at, q -> q <= p AND p < q + {n}))"
    pairs = f"transform({spots}, p -> struct(p AS p, toks[p] AS i, doc_toks[p + shift] AS d))"
    # values by their places, the unchanged one first on a tie
    scored = "transform(array_distinct(transform(l, x -> struct(x.i AS i, x.d AS d))), k -> struct(k.i AS i, k.d AS d, 2 * size(filter(l, x -> x.i = k.i AND x.d = k.d)) + int(k.i = k.d) AS s))"
    stand_in = "filter(k, x -> NOT exists(k, o -> o.i = x.i AND o.d <> x.d AND (o.s > x.s OR (o.s = x.s AND o.d < x.d))))"
    wrong = f"element_at(transform(array({pairs}), l -> element_at(transform(array({scored}), k -> element_at(transform(array({stand_in}), ok -> filter(l, x -> NOT exists(ok, y -> y.i = x.i AND y.d = x.d))), 1)), 1)), 1)"
    return [F.expr(f"element_at(transform(array({wrong}), bad -> filter(at, q -> NOT exists(bad, x -> q <= x.p AND x.p < q + {n}))), 1) AS at_")]


def keep_clean(docs: DataFrame, benchmark: DataFrame, **params) -> DataFrame:
    """The rows of ``docs`` that no benchmark item contaminates."""
    bad = contaminated(docs, benchmark, **params).select(F.col("doc_id").alias("_llm_id"), F.col("text_hash").alias("_llm_text")).distinct()
    bad = written(bad, "contaminated")
    th = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(maybe_broadcast(bad, 40), F.col("doc_id").eqNullSafe(F.col("_llm_id")) & (th == F.col("_llm_text")), "left_anti")
