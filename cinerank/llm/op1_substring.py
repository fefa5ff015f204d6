"""Substring deduplication by paragraph MinHash banding.

Paragraphs.  Passages that documents share start and end anywhere, also in the
middle of a line, so paragraph ends are taken from the content: a word opens a
paragraph when the hash of it and its next word is the smallest among the
``reach`` word pairs on either side.  A shared passage thus falls into the same
paragraphs in every document, wherever it stands (about ``2 * reach + 1`` words
each; whole texts, no word is left out).

Candidates.  Equal paragraphs (by a 64-bit hash of their words) are one from the
start, counted with map-side combining however many documents hold them.  Each
paragraph has a MinHash signature of its five-word shingles, cut into bands; ``tune_bands`` picks the rows per band so that a pair at the threshold
collides with the asked recall.  A band's paragraphs are paired with the band's
smallest one (m - 1 pairs, not all); once the verified pairs are contracted, those
of a band that are still in different components are compared as well, dealt by
pairs of the rare shingles that a pair at the threshold must share (an exact filter).

Verification and clusters.  Pairs are verified by the exact Jaccard similarity of
their shingle sets (``100 * common >= pct * union``), and verified pairs are
clustered by connected components.  A cluster found more than once is repeated
text.  Every occurrence but the cluster's first (smallest document, then position)
is removed, so one copy of every passage stays; neighbouring repeated paragraphs
of a document (with at most one short paragraph between them) that are alike in
this join to spans, and spans of ``min_words`` words or more are the result.

Passages.  The paragraphs at a passage's ends also hold words around it, so what is
left can be short.  Anchors therefore repeat the search by exact runs of
``min(min_words, 25)`` words, of which every verbatim passage of ``PASSAGE`` words has
one in all its copies (winnowing); an anchor is a cluster like a paragraph, and
both make up the spans.  A repeat of fewer words may fall below ``min_words``.

Defined results: null text equals empty text, which has no paragraph; texts
shorter than a paragraph are one; repeats inside one document count as repeats;
rows with a null ``doc_id`` take part and are reported under null; rows alike in
id and text are one document; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cinerank.llm.common import _WORD_MUL, Words, maybe_broadcast, mix64, shingles, text_slices, written
from cinerank.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Verbatim passages of so many words are found wherever paragraphs end, by an anchor of at most ANCHOR words.
PASSAGE, ANCHOR = 51, 25
#: Shingle sets of at most this size are dealt by pairs of rare shingles, larger ones by single ones.
PAIRED = 24


def tune_bands(pct: int, hashes: int, recall: float) -> tuple[int, int]:
    """(bands, rows): the most selective banding of ``hashes`` MinHashes that finds a pair at the
    threshold with the asked probability."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - (pct / 100) ** rows) ** bands >= recall:
            return bands, rows
    return hashes, 1


def _starts(h: np.ndarray, offs: np.ndarray, reach: int) -> np.ndarray:
    """Words that open a paragraph: local minima of the word-pair hash, and each text's first word.

    A window ends with its text, so the cut does not depend on the texts around it.
    """
    n = len(h)
    count = np.diff(offs)
    pos = np.arange(n) - np.repeat(offs[:-1], count)
    rest = np.repeat(count, count) - 1 - pos
    nxt = np.where(rest > 0, np.append(h[1:], np.uint64(0)), np.uint64(0))
    key = mix64(h * _WORD_MUL[0] + nxt * _WORD_MUL[1])
    opens = np.ones(n, dtype=bool)
    for k in range(1, min(reach, n - 1) + 1):
        opens[k:] &= (key[k:] < key[:-k]) | (pos[k:] < k)
        opens[:-k] &= (key[:-k] <= key[k:]) | (rest[:-k] < k)
    opens[pos == 0] = True
    return np.flatnonzero(opens)


def _anchors(h: np.ndarray, offs: np.ndarray, size: int, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of runs of ``size`` words such that every passage of ``whole`` words has one
    that depends on the passage alone: the least hash of each ``whole - size + 1`` neighbouring runs.

    A run of one word over and over is none.
    """
    width = whole - size + 1
    if len(h) < whole:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    s = np.zeros(len(h) - size + 1, dtype=np.uint64)
    for k in range(size):
        s += h[k : len(h) - size + 1 + k] * _WORD_MUL[k]
    s = mix64(s ^ _WORD_MUL[63])
    alike = np.concatenate([[0], np.cumsum(h[1:] == h[:-1])])
    plain = alike[size - 1 :] - alike[: len(alike) - size + 1] == size - 1
    key = np.where(plain, np.uint64(2**64 - 1), s)
    first = np.arange(len(key) - width + 1)
    least = first + np.lib.stride_tricks.sliding_window_view(key, width).argmin(axis=1)
    end = np.repeat(offs[1:], np.diff(offs))
    at = np.unique(least[first + whole <= end[first]])
    at = at[~plain[at]]
    return at, s[at]


class _Cut:
    """Paragraphs of a run of texts: word ranges, text numbers, hashes."""

    def __init__(self, buf, offs, reach: int):
        self.w = Words(buf, offs)
        h = self.w.hash
        self.first = _starts(h, self.w.offs, reach) if len(h) else np.zeros(0, np.int64)
        self.last = np.append(self.first[1:], len(h)) if len(h) else self.first
        self.doc = np.searchsorted(self.w.offs, self.first, side="right") - 1
        self.pos = self.first - self.w.offs[self.doc]
        if len(h):
            place = np.arange(len(h)) - np.repeat(self.first, self.last - self.first)
            s = np.add.reduceat(mix64(h + mix64(place.astype(np.uint64))), self.first)
            self.hash = mix64(s + (self.last - self.first).astype(np.uint64))
            self.grams, self.go = shingles(_Range(h, np.append(self.first, len(h))), 5)
        else:
            self.hash, self.grams, self.go = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(1, np.int64)


class _Range:
    def __init__(self, h, offs):
        self.hash, self.offs = h, offs


def _paragraphs(reach: int, size: int):
    """Paragraphs, and the anchors (``whole`` false) of ``size`` words."""

    def run(batches):
        for rb, buf, offs in text_slices(batches):
            c = _Cut(buf, offs, reach)
            at, key = _anchors(c.w.hash, c.w.offs, size, max(PASSAGE, size))
            doc = np.searchsorted(c.w.offs, at, side="right") - 1
            cols = [rb.column(rb.schema.get_field_index(x)).take(pa.array(np.concatenate([c.doc, doc]))) for x in ("doc_id", "row")]
            cols += [pa.array(np.concatenate([c.pos, at - c.w.offs[doc]]).astype(np.int32)), pa.array(np.concatenate([c.last - c.first, np.full(len(at), size)]).astype(np.int32))]
            cols += [pa.array(np.concatenate([c.hash, key]).view(np.int64)), pa.array(np.arange(len(c.hash) + len(at)) < len(c.hash))]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "row", "pos", "words", "p", "whole"])

    return run


def _bands(reach: int, bands: int, rows: int):
    """(paragraph, its band values) for each distinct paragraph of a slice of texts."""

    def run(batches):
        for _, buf, offs in text_slices(batches):
            c = _Cut(buf, offs, reach)
            if len(c.hash) == 0:
                continue
            one = np.unique(c.hash, return_index=True)[1]
            cols = [pa.array(c.hash[one].view(np.int64))]
            for b in range(bands):
                sig = np.full(len(one), b + 1, dtype=np.uint64)
                for r in range(rows):
                    salt = mix64(np.array([b * rows + r + 1], dtype=np.uint64))
                    sig = mix64(sig * np.uint64(31) + np.minimum.reduceat(mix64(c.grams ^ salt), c.go[:-1])[one])
                cols.append(pa.array(sig.view(np.int64)))
            yield pa.RecordBatch.from_arrays(cols, names=["p", *[f"b{b}" for b in range(bands)]])

    return run


def _shingle_lists(reach: int):
    """(paragraph, its shingles in order) for each distinct paragraph of a slice of texts."""

    def run(batches):
        for _, buf, offs in text_slices(batches):
            c = _Cut(buf, offs, reach)
            if len(c.hash) == 0:
                continue
            one = np.unique(c.hash, return_index=True)[1]
            count = c.go[one + 1] - c.go[one]
            so = np.concatenate([[0], np.cumsum(count)])
            flat = c.grams[np.repeat(c.go[one] - so[:-1], count) + np.arange(so[-1])]
            lists = pa.ListArray.from_arrays(pa.array(so.astype(np.int32)), pa.array(flat.view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(c.hash[one].view(np.int64)), lists], names=["p", "tokens"])

    return run


def _cut_spans(hits, gap: int):
    """(first word, words, paragraphs, most documents, removed) spans of one text's hits
    (position, words, is first, documents, is a paragraph and no anchor): neighbours at most ``gap`` words apart and alike in
    being removed.  A word goes when any hit on it is not the cluster's first."""
    hits = sorted(hits)
    ends = sorted({x for p, n, *_ in hits for x in (p, p + n)})
    spans, live, at = [], [], 0
    for lo, hi in zip(ends, ends[1:]):
        live = [h for h in live if h[0] + h[1] > lo]
        opened = 0
        while at < len(hits) and hits[at][0] == lo:
            live.append(hits[at])
            at, opened = at + 1, opened + hits[at][4]
        if not live:
            continue
        removed, docs = not all(h[2] for h in live), max(h[3] for h in live)
        s = spans[-1] if spans else None
        if s and s[4] == removed and lo - s[5] <= gap:
            spans[-1] = (s[0], s[1] + hi - lo, s[2] + opened, max(s[3], docs), removed, hi)
        else:
            spans.append((lo, hi - lo, opened, docs, removed, hi))
    return [s[:5] for s in spans]


def _spans(gap: int):
    names = ["first_word", "n_words", "n_paragraphs", "cluster_docs"]

    def run(batches):
        for rb in batches:
            got, doc = [], []
            for i, hits in enumerate(rb.column(rb.schema.get_field_index("hits"))):
                mine = _cut_spans([(h["pos"], h["words"], h["first"], h["docs"], h["whole"]) for h in hits.as_py()], gap)
                got += mine
                doc += [i] * len(mine)
            cols = [rb.column(rb.schema.get_field_index("doc_id")).take(pa.array(doc, pa.int64()))]
            cols += [pa.array([g[k] for g in got], pa.int64()) for k in range(4)] + [pa.array([g[4] for g in got], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", *names, "removed"])

    return run


def _verified(pairs: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach the threshold."""
    side = lambda c: sets.select(F.col("p").alias(c), F.col("tokens").alias(f"t{c}"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(100 * both >= pct * (F.size("ta") + F.size("tb") - both)).select("a", "b")


def _rarest(sets: DataFrame, pct: int) -> DataFrame:
    """(p, n, pre): size of each set and its rarest ``n - ceil(pct * n / 100) + 2`` tokens, rarest first."""
    tok = sets.select("p", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    df = written(tok.groupBy("token").agg(F.count(F.lit(1)).alias("df")), "df")
    rank = F.row_number().over(Window.partitionBy("p").orderBy("df", "token"))
    pre = tok.join(maybe_broadcast(df, 24), "token").withColumn("rn", rank).where(f"rn <= n - ({pct}L * n + 99) div 100 + 2")
    return pre.groupBy("p", "n").agg(F.expr("transform(array_sort(collect_list(struct(rn, token))), x -> x.token)").alias("pre"))


# Two sets that share o tokens share 1 + e of each one's rarest n - o + 1 + e, for every e under o.

#: Pairs of a set's first ``{k}`` rarest tokens, or its first ``{k} - 1`` alone, under a tag.
_PAIRS = "flatten(transform(slice(pre, 1, {k}), (x, i) -> transform(slice(pre, i + 2, greatest({k} - i - 1, 0)), y -> xxhash64({tag}, x, y))))"
_SINGLE = "transform(slice(pre, 1, {k} - 1), x -> xxhash64({tag}, x))"
_NONE = "cast(array() AS array<bigint>)"


def _any_partner(pct: int) -> str:
    """Keys that meet in any two sets at the threshold: pairs of rare tokens (e = 1) where both have at most
    PAIRED tokens and must share two, single ones (e = 0) otherwise."""
    k = f"int(n - ({pct}L * n + 99) div 100 + 2)"
    two = f"n <= {PAIRED} AND ({pct}L * n + 99) div 100 >= 2"
    pairs, single = _PAIRS.format(k=k, tag=1), _SINGLE.format(k=k, tag=0)
    alone = f"NOT ({two}) OR 100L * n >= {pct}L * ({PAIRED} + 1) OR {pct}L * n <= 100L * (100 div {pct})"
    return f"concat(CASE WHEN {two} THEN {pairs} ELSE {_NONE} END, CASE WHEN {alone} THEN {single} ELSE {_NONE} END)"


def _each_partner(pct: int) -> str:
    """(partner size, key) for each partner size up to PAIRED: the sizes say how many tokens must be shared, so
    the part that must meet is shorter."""
    o = f"(({pct}L * (n + s) + {99 + pct}) div {100 + pct})"
    k, tag = f"int(least(n - {o} + 2, size(pre)))", "2, least(n, s), greatest(n, s)"
    keys = f"CASE WHEN {o} >= 2 THEN {_PAIRS.format(k=k, tag=tag)} ELSE {_SINGLE.format(k=k, tag=tag)} END"
    sizes = f"sequence(int(({pct}L * n + 99) div 100), int(least({PAIRED}L, 100L * n div {pct})))"
    return f"flatten(transform({sizes}, s -> transform({keys}, key -> struct(s, key))))"


def _still_apart(band: DataFrame, comp: DataFrame, sets: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs (a, b) of a band in different components that can reach the threshold.

    A band is dealt by keys that two such sets share, first by those for any partner, then, up to
    PAIRED tokens, by those for each partner size; of two components one is not the group's largest.
    """

    def groups(df: DataFrame, *key: str) -> DataFrame:
        per = df.groupBy(*key, "comp").agg(F.count(F.lit(1)).alias("m"))
        most = per.groupBy(*key).agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("m", "comp")).alias("main"))
        return df.join(most.where("comps > 1").select(*key, F.col("main.comp").alias("main")), [*key])

    lab = band.join(maybe_broadcast(comp.withColumnRenamed("node", "p"), 24), "p", "left").withColumn("comp", F.coalesce("root", "p")).drop("root")
    lab = written(groups(lab, "band").drop("main"), "open")
    some = sets.join(maybe_broadcast(written(lab.select("p").distinct(), "open"), 16), "p", "left_semi")
    pre = written(_rarest(some, pct), "rarest")
    met = written(groups(lab.join(pre.select("p", "n", F.explode(F.expr(_any_partner(pct))).alias("key")), "p"), "band", "key"), "met")

    out = lambda df, *c: df.where("comp <> main").selectExpr("band", "key", "p AS x", "n AS nx", "comp AS cx", *c)
    large = met.where(f"100L * n >= {pct}L * ({PAIRED} + 1)")
    more = large.join(out(large), ["band", "key"]).where(f"cx <> comp AND (comp = main OR x < p) AND greatest(n, nx) > {PAIRED}")
    more = more.where(f"100L * least(n, nx) >= {pct}L * greatest(n, nx)")

    small = met.where(f"n <= {PAIRED}").select("band", "p", "comp").distinct().join(pre, "p")
    small = small.select("band", "p", "comp", "n", F.explode(F.expr(_each_partner(pct))).alias("k")).select("band", "p", "comp", "n", "k.s", "k.key")
    small = written(groups(small, "band", "key"), "met")
    # a row meets the rows of its partner's size, which expect its own
    other = out(small, "s AS sx")
    near = small.join(other.withColumnRenamed("nx", "s"), ["band", "key", "s"]).where("sx = n AND cx <> comp AND (comp = main OR x < p)")
    return more.selectExpr("p AS a", "x AS b").union(near.selectExpr("p AS a", "x AS b")).distinct()


def repeated_spans(docs: DataFrame, pct: int = 80, min_words: int = 25, reach: int = 6, hashes: int = 6, recall: float = 0.95) -> DataFrame:
    """``doc_id, first_word, n_words, n_paragraphs, cluster_docs, removed``: one row per repeated span,
    with the most documents that share a paragraph of it and whether all of it is removed or all stays."""
    if not 1 <= pct <= 100 or min_words < 1 or reach < 1:
        raise ValueError("pct must be in 1..100, min_words and reach at least 1")
    bands, rows = tune_bands(pct, hashes, recall)
    text = F.col("text").cast("string")
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("row"), text.alias("text"))
    par = written(d.mapInArrow(_paragraphs(reach, min(min_words, ANCHOR)), "doc_id long, row long, pos int, words int, p long, whole boolean"), "paragraphs")

    spot = F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("d"), "row", "pos")
    # signatures of equal paragraphs are met with map-side combining, so a paragraph is in a band once
    names = [f"b{b}" for b in range(bands)]
    sig = d.select("text").mapInArrow(_bands(reach, bands, rows), "p long, " + ", ".join(f"{b} long" for b in names))
    sig = written(sig.groupBy("p").agg(*[F.min(b).alias(b) for b in names]), "signatures")
    band = sig.select("p", F.explode(F.array(*names)).alias("band"))
    shared = written(band.groupBy("band").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).where("lo <> hi").select("band", "lo"), "shared")
    band = written(band.join(maybe_broadcast(shared, 24), "band"), "bands")
    lists = d.select("text").mapInArrow(_shingle_lists(reach), "p long, tokens array<long>")
    sets = lists.join(maybe_broadcast(written(band.select("p").distinct(), "asked"), 16), "p", "left_semi").dropDuplicates(["p"])
    sets = written(sets.select("p", F.array_distinct("tokens").alias("tokens")), "sets")
    # every paragraph against its band's smallest one, then what these links leave apart
    near = _verified(written(band.where("p <> lo").selectExpr("p AS a", "lo AS b").distinct(), "pairs"), sets, pct)
    near = written(near, "near")
    rest = written(_still_apart(band.where("p <> lo").select("band", "p"), components(near), sets, pct), "pairs")
    near = near.union(_verified(rest, sets, pct))
    comp = components(near)

    lab = par.join(maybe_broadcast(comp.withColumnRenamed("node", "p"), 24), "p", "left").withColumn("c", F.coalesce("root", "p")).select("doc_id", "row", "pos", "words", "c", "whole")
    # clusters met more than once, first by a plain count, then without the repeats of alike rows
    often = written(lab.groupBy("c").count().where("count > 1").select("c"), "often")
    hit = written(lab.join(maybe_broadcast(often, 16), "c").dropDuplicates(["doc_id", "row", "pos", "whole"]), "hits")
    cl = hit.groupBy("c").agg(F.min(spot).alias("s"), F.count(F.lit(1)).alias("n")).where("n > 1")
    many = hit.select("c", "doc_id", "row").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("docs"))
    cl = written(cl.join(many, "c").select("c", "s", "docs"), "clusters")
    hit = hit.join(maybe_broadcast(cl, 56), "c").withColumn("first", spot == F.col("s")).drop("s")
    per = hit.groupBy("doc_id", "row").agg(F.collect_list(F.struct("pos", "words", "first", "docs", "whole")).alias("hits"))
    out = per.mapInArrow(_spans(4 * reach), "doc_id long, first_word long, n_words long, n_paragraphs long, cluster_docs long, removed boolean")
    return out.where(F.col("n_words") >= min_words)
