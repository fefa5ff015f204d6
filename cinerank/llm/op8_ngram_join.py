"""N-gram Jaccard join by multiple-global-order filtering, and its duplicate classes.

Two documents link when the Jaccard similarity of their word-shingle sets is at
least a threshold ``t`` (an exact integer test).  Under *any* global token order, two
such sets share at least ``1 + min(e, e')`` tokens of the smaller set's first
``m - ceil(2t/(1+t) m) + 1 + e`` (its inner prefix) and the larger set's first
``m' - ceil(t m') + 1 + e'`` tokens (its prefix), whatever ``e >= 0`` each of
them adds, so a candidate must share that many under each of several orders.

1. One pass hashes every whole text to its distinct shingles and emits only the
   set size and a digest of the set.  Documents with equal sets are one *class*
   from here on, so exact copies cost nothing later, however many there are.
2. The same pass counts shingles per chunk; those that many documents share
   form a bounded set of *common* shingles, and every order puts common shingles
   last.  Any such set gives valid orders (so it never changes a result); it
   keeps shared passages and boilerplate out of the prefixes.
3. The first order's prefixes are posted, each token with its place in them, and joined
   on the token.  Two sets of known sizes must share ``o`` tokens, hence one within the
   first ``m - o + 1`` of each, which is shorter than what a set posts for any partner: only such
   rows make a pair.  A token's classes are first compared with one pivot only (m - 1
   pairs, not m^2).  Common tokens, which only near-copy groups have in a prefix, are
   grouped by a map-side-combined aggregate and a join that adaptive execution may split.
4. Pairs must then share enough tokens of their prefixes and meet in the prefixes under
   two further orders; what passes all filters is verified with the exact
   intersection of the whole sets, which are read for those classes alone.
5. Verified links are contracted to components.  (This first turn only saves
   work: a pair that it drops comes again.)  The last turn takes every pair of
   classes of different components that share a prefix token and puts it through
   the filters.  A pair left out is thus always one whose ends are already
   connected: no component can change, and no cap exists.

Defined results: null text equals empty text (size 0, its own component, linked
with nothing); fewer than ``n`` words make one shingle of the whole sequence;
repeated rows and equal texts link; a row with a null ``doc_id`` takes part and
can link others, its component is the smallest non-null id, or null; an empty
table gives an empty table; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinerank.llm.common import SMALL_BATCH_BYTES, SMALL_SLICE_BYTES, Words, column, maybe_broadcast, mix64, shingles, text_slices, written
from cinerank.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Shingles counted together inside a task before shared ones are emitted.
CHUNK_SHINGLES = 1_000_000
#: Rows that a task hands to Spark at once.
OUT_ROWS = 16_384
#: A shingle is common when its chunk counts (of 2 or more) sum to this many
#: classes; at most COMMON_MAX of them (8 bytes each) are sent to the tasks.
COMMON_DF = 40
COMMON_MAX = 1_000_000
#: One prefix token in EXTRA set members is posted beyond the least, and as many must be shared.
EXTRA = 12
#: Further token orders that a candidate pair must pass.
EXTRA_ORDERS = 2


def _sets(batches: Iterator[pa.RecordBatch], n: int):
    """(doc_id or None, set) for each row; the set is sorted and distinct."""
    for rb, buf, offs in text_slices(batches, most=SMALL_SLICE_BYTES):
        h, so = shingles(Words(buf, offs), n)
        ids = rb.column(rb.schema.get_field_index("doc_id"))
        for i in range(rb.num_rows):
            yield ids[i].as_py(), np.unique(h[so[i] : so[i + 1]])


def _class_of(s: np.ndarray) -> int:
    """The class id: 63 bits of a digest of the sorted set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little") >> 1


def _extra(m: int, pct: int) -> int:
    """Prefix tokens beyond the least; the same rule in SQL is in ``_extra_sql``."""
    return min(m // EXTRA, (pct * m + 99) // 100 - 1)


def _extra_sql(m: str, pct: int) -> str:
    return f"least({m} div {EXTRA}, ({pct}L * {m} + 99) div 100 - 1)"


def _prefix_sizes(m: int, pct: int) -> tuple[int, int]:
    """(inner prefix, prefix): enough for a partner that is not smaller, and for any partner."""
    e = 1 + _extra(m, pct)
    return m - (2 * pct * m + 99 + pct) // (100 + pct) + e, m - (pct * m + 99) // 100 + e


def _prefix(s: np.ndarray, common: np.ndarray, k: int, pct: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """The prefix of a set under global order k (common tokens last), which of it are common, how
    many of it, from the start, are the inner prefix, and its end's place in the order."""
    inner, p = _prefix_sizes(len(s), pct)
    key = mix64(s + np.uint64(2 * k + 1)) >> np.uint64(1)
    is_common = np.zeros(len(s), dtype=bool)
    if len(common):
        is_common = common[np.minimum(np.searchsorted(common, s), len(common) - 1)] == s
        key |= is_common.astype(np.uint64) << np.uint64(63)
    by = np.argpartition(key, p - 1)[:p] if p < len(s) else np.arange(len(s))
    by = by[np.argsort(key[by])]
    return s[by], is_common[by], inner, int(key[by[-1]]) - (1 << 63)


def _scan(n: int):
    """Rows of two kinds: (doc_id, size, class) per row, and (token, count) of shared shingles."""

    def run(batches):
        seen: set[int] = set()
        pend, held = [], 0
        rows: list[tuple] = []

        def shared():
            nonlocal pend, held
            tok = np.concatenate(pend) if pend else np.zeros(0, np.uint64)
            pend, held = [], 0
            tok.sort()
            # a shared token's first and last place: its neighbour on one side only is the same
            same = tok[1:] == tok[:-1]
            at = np.flatnonzero(same & ~np.append(False, same[:-1]))
            df = np.flatnonzero(same & ~np.append(same[1:], False)) - at + 2
            for i in range(0, len(at), OUT_ROWS):
                t, none = tok[at[i : i + OUT_ROWS]].view(np.int64), pa.nulls(min(OUT_ROWS, len(at) - i), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, column(t), column(df[i : i + OUT_ROWS])], names=["doc_id", "size", "cid", "token", "df"])

        def flush():
            known = np.array([r[0] is not None for r in rows], dtype=bool)
            cols = [np.array([r[j] or 0 for r in rows], dtype=np.int64) for j in range(3)]
            out = pa.RecordBatch.from_arrays([column(cols[0], known), column(cols[1]), column(cols[2]), *[pa.nulls(len(rows), pa.int64())] * 2], names=["doc_id", "size", "cid", "token", "df"])
            rows.clear()
            return out

        for doc, s in _sets(batches, n):
            c = _class_of(s)
            rows.append((doc, len(s), c))
            if c not in seen and len(s):
                seen.add(c)
                pend.append(s)
                held += len(s)
                if held >= CHUNK_SHINGLES:
                    yield from shared()
                    seen.clear()
            if len(rows) >= OUT_ROWS:
                yield flush()
        yield flush()
        yield from shared()

    return run


def _postings(n: int, pct: int, common):
    """(token, class, size, is common, place in the prefix) of the first order's prefixes, once per class
    and chunk; the row of the prefix's last token has its place in the order, ``last``."""

    def run(batches):
        seen: set[int] = set()
        acc, held = [], 0

        def flush():
            nonlocal acc, held
            cols = [np.concatenate([a[j] for a in acc]) if acc else np.zeros(0, d) for j, d in enumerate((np.int64, np.int64, np.int32, bool, np.int32, np.int64, bool))]
            acc, held = [], 0
            return pa.RecordBatch.from_arrays([*[column(c) for c in cols[:5]], column(cols[5], ~cols[6])], names=["token", "cid", "size", "is_common", "pos", "last"])

        for _, s in _sets(batches, n):
            m = len(s)
            if m == 0:
                continue
            c = _class_of(s)
            if c in seen:
                continue
            seen.add(c)
            if len(seen) > 200_000:
                seen.clear()
            tok, com, _, last = _prefix(s, common.value, 0, pct)
            p = len(tok)
            acc.append((tok.view(np.int64), np.full(p, c, np.int64), np.full(p, m, np.int32), com, np.arange(p, dtype=np.int32), np.full(p, last, np.int64), np.arange(p) < p - 1))
            held += p
            if held >= OUT_ROWS:
                yield flush()
        yield flush()

    return run


def _whole(n: int, pct: int, common):
    """(class, set, prefix under each further order) of the rows read."""

    def run(batches):
        acc, held = [], 0
        names = ["cid", "tokens", *[f"p{k}" for k in range(1, EXTRA_ORDERS + 1)]]

        def listed(j):
            parts = [a[j] for a in acc]
            offs = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
            return pa.ListArray.from_arrays(column(offs), column(np.concatenate(parts)))

        def flush():
            nonlocal acc, held
            out = pa.RecordBatch.from_arrays([column(np.array([a[0] for a in acc], dtype=np.int64)), *[listed(j) for j in range(1, EXTRA_ORDERS + 2)]], names=names)
            acc, held = [], 0
            return out

        seen: set[int] = set()
        for _, s in _sets(batches, n):
            c = _class_of(s)
            if c in seen:
                continue
            seen.add(c)
            # a further prefix is kept as 32-bit hashes: a collision only lets a pair through to the exact test
            acc.append((c, s.view(np.int64), *[_prefix(s, common.value, k, pct)[0].astype(np.uint32).view(np.int32) for k in range(1, EXTRA_ORDERS + 1)]))
            held += len(s)
            if held >= 100_000:
                yield flush()
        if acc:
            yield flush()

    return run


def _inner_sql(m: str, pct: int) -> str:
    """How many tokens of a set meet any partner that is not smaller, without the extra ones."""
    return f"{m} - (2 * {pct}L * {m} + {99 + pct}) div {100 + pct} + 1"


def _meet(rows: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs (a, b, na) from rows (cid, size, most, last, pos; x, nx, mx, lx, px) of two classes that
    share a token: sizes and possible overlaps that can reach the threshold, and the token among the first
    ``m - o + 1`` of either class, o being the overlap that their sizes ask for.

    The class whose prefix ends first has no token of it in the other set but those in both
    prefixes, so its ``most`` bounds the overlap.  ``a`` is the smaller class (by size, then class).
    """
    smaller = F.expr("nx < size OR (nx = size AND x < cid)")
    o = f"({pct}L * (size + nx) + {99 + pct}) div {100 + pct}"
    r = rows.where("x <> cid").where(f"100L * least(nx, size) >= {pct}L * greatest(nx, size)")
    r = r.where(f"pos <= size - {o} AND px <= nx - {o}").where(f"CASE WHEN lx < last THEN mx ELSE most END >= {o}")
    r = r.select(*[F.when(smaller, F.col(p)).otherwise(F.col(q)).alias(c) for c, p, q in (("a", "x", "cid"), ("b", "cid", "x"))], F.least("nx", "size").alias("na"))
    return r.distinct()


def _share_enough(pairs: DataFrame, met: DataFrame, pct: int) -> DataFrame:
    """The pairs (a, b) that share ``1 + e`` tokens of the smaller one's inner prefix and the other's prefix."""
    ids = written(pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct(), "asked")
    inner = F.when(F.expr(f"pos < {_inner_sql('size', pct)} + {_extra_sql('size', pct)}"), F.col("token"))
    own = met.join(maybe_broadcast(ids, 16), "cid", "left_semi").groupBy("cid").agg(F.collect_set("token").alias("all"), F.collect_set(inner).alias("inner"))
    own = written(own, "prefixes")
    both = pairs.join(own.select(F.col("cid").alias("a"), "inner"), "a").join(own.select(F.col("cid").alias("b"), "all"), "b")
    return both.where(f"size(array_intersect(inner, all)) >= 1 + {_extra_sql('na', pct)}").select("a", "b")


def _verify(pairs: DataFrame, whole: DataFrame, pct: int) -> DataFrame:
    """The pairs that meet under every further order and pass the exact test on whole sets."""
    cols = ["tokens", *[f"p{k}" for k in range(1, EXTRA_ORDERS + 1)]]

    def side(c: str) -> DataFrame:
        ids = pairs.select(F.col(c).alias("cid")).distinct()
        mine = whole.join(maybe_broadcast(ids, 16), "cid", "left_semi")
        return mine.select(F.col("cid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in cols])

    near = pairs.join(side("a"), "a").join(side("b"), "b")
    for p in cols[1:]:
        near = near.where(F.arrays_overlap(f"{p}_a", f"{p}_b"))
    both = F.size(F.array_intersect("tokens_a", "tokens_b"))
    return near.where(100 * both >= pct * (F.size("tokens_a") + F.size("tokens_b") - both)).select("a", "b")


class _Sets:
    """Whole sets of the classes asked for so far, each read from its texts once."""

    def __init__(self, docs: DataFrame, members: DataFrame, n: int, pct: int, common):
        self.n, self.pct, self.common, self.have = n, pct, common, None
        self.key = F.coalesce("doc_id", F.lit(-(2**63)))
        self.docs = docs.withColumn("doc_key", self.key)
        self.first = members.groupBy("cid").agg(F.min(self.key).alias("doc_key"))

    def of(self, pairs: DataFrame) -> DataFrame:
        want = pairs.select(F.col("a").alias("cid")).union(pairs.select(F.col("b").alias("cid"))).distinct()
        if self.have is not None:
            want = want.join(self.have.select("cid"), "cid", "left_anti")
        keys = written(want.join(self.first, "cid").select("doc_key").distinct(), "wanted")
        some = self.docs.join(maybe_broadcast(keys, 16), "doc_key", "left_semi").select("doc_id", "text")
        schema = "cid long, tokens array<long>, " + ", ".join(f"p{k} array<int>" for k in range(1, EXTRA_ORDERS + 1))
        new = written(some.mapInArrow(_whole(self.n, self.pct, self.common), schema), "whole", SMALL_BATCH_BYTES)
        if self.have is not None:
            new = new.join(self.have.select("cid"), "cid", "left_anti")
        # a class has one first document, so only repeated ids can bring a class twice
        if new.groupBy("cid").count().where("count > 1").limit(1).count():
            new = written(new.dropDuplicates(["cid"]), "whole")
        self.have = new if self.have is None else self.have.union(new)
        return self.have


def classes_and_links(docs: DataFrame, n: int = 5, pct: int = 80) -> tuple[DataFrame, DataFrame]:
    """(members, links): ``members`` has (doc_id, size, cid) for every row, ``links`` (a, b) verified
    class pairs that connect exactly the components of the full similarity join."""
    if not 1 <= pct <= 100 or n < 1 or n > 60:
        raise ValueError("pct must be in 1..100 and n in 1..60")
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scan = written(d.mapInArrow(_scan(n), "doc_id long, size long, cid long, token long, df long"), "scan", SMALL_BATCH_BYTES)
    members = scan.where("cid IS NOT NULL").select("doc_id", "size", "cid")
    df = scan.where("token IS NOT NULL").groupBy("token").agg(F.sum("df").alias("df")).where(f"df >= {COMMON_DF}")
    top = df.orderBy(F.desc("df"), "token").limit(COMMON_MAX).select("token").toPandas()["token"].to_numpy(np.int64)
    common = spark.sparkContext.broadcast(np.sort(top.view(np.uint64)))

    post = written(d.mapInArrow(_postings(n, pct, common), "token long, cid long, size int, is_common boolean, pos int, last long"), "post", SMALL_BATCH_BYTES)
    # tokens that two classes have.  Rare ones: one shuffle, a token's classes meet in one
    # small window; common ones, which only near-copy groups have in a prefix, are grouped
    # with map-side combining and a join that may be split.  A class that several tasks
    # have posted counts once from here on
    over = "OVER (PARTITION BY token)"
    rare = post.where("NOT is_common").selectExpr("token", "cid", "size", "pos", f"min(cid) {over} AS lo", f"max(cid) {over} AS hi")
    rare = rare.where("lo <> hi").dropDuplicates(["token", "cid"])
    often = post.where("is_common").dropDuplicates(["token", "cid"])
    tops = often.groupBy("token").agg(F.min("cid").alias("lo"), F.max("cid").alias("hi")).where("lo <> hi")
    often = often.join(tops.select("token"), "token", "left_semi")
    met = written(rare.select("token", "cid", "size", "pos").union(often.select("token", "cid", "size", "pos")), "met")
    # the most that a class can share with one whose prefix ends later: all but those prefix
    # tokens that no other prefix has.  A pair needs one class that can reach the threshold
    # so, hence a token without such a class links nobody
    own = f"size - ({pct}L * size + 99) div 100 + 1 + {_extra_sql('size', pct)}"
    ends = post.where("last IS NOT NULL").groupBy("cid").agg(F.max("last").alias("last"))
    can = met.groupBy("cid", "size").agg(F.count(F.lit(1)).alias("k")).selectExpr("cid", f"least(size, size - ({own}) + k) AS most").join(ends, "cid")
    met = met.join(maybe_broadcast(written(can, "can"), 32), "cid")
    met = written(met.join(met.where(f"100L * most >= {pct}L * size").select("token").distinct(), "token", "left_semi"), "met")

    # rows that can make a pair with some partner
    front = met.where(f"pos <= size - ({pct}L * size + 99) div 100")
    sets, links = _Sets(d, members, n, pct, common), None
    for last in (False, True):
        if not last:
            # every class against the token's most central one: the one with the least of its own
            centre = front.groupBy("token").agg(F.min(F.struct((F.col("size") - F.col("most")).alias("own"), "cid", "size", "most", "last", "pos")).alias("c"))
            more = front.join(centre.selectExpr("token", "c.cid AS x", "c.size AS nx", "c.most AS mx", "c.last AS lx", "c.pos AS px"), "token")
        else:
            comp = components(links).withColumnRenamed("node", "cid")
            lab = front.join(maybe_broadcast(comp, 24), "cid", "left").withColumn("comp", F.coalesce("root", "cid")).drop("root")
            # tokens with two components or more, and each token's largest one; every pair
            # of two components has an end outside it
            per = lab.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("m"))
            open_ = per.groupBy("token").agg(F.count(F.lit(1)).alias("comps"), F.max(F.struct("m", "comp")).alias("main"))
            lab = lab.join(open_.where("comps > 1").selectExpr("token", "main.comp AS main"), "token")
            out = lab.where("comp <> main").selectExpr("token", "cid AS x", "size AS nx", "most AS mx", "last AS lx", "pos AS px", "comp AS cx")
            more = lab.join(out, "token").where("cx <> comp AND (comp = main OR x < cid)")
        more = written(_meet(more, pct), "pairs")
        more = written(_share_enough(more, met, pct), "pairs")
        found = _verify(more, sets.of(more), pct)
        links = written(found if links is None else links.union(found), "links")
    return members, links


def _labelled(docs: DataFrame, n: int, pct: int) -> tuple[DataFrame, DataFrame]:
    """(members, labels): every row's (doc_id, size, cid), and (cid, root, component_id) of the classes with words."""
    members, links = classes_and_links(docs, n, pct)
    comp = components(links).withColumnRenamed("node", "cid")
    # an empty set links with nothing: such a row is its own component
    per_class = members.where("size > 0").groupBy("cid").agg(F.min("doc_id").alias("lo"))
    lab = per_class.join(comp, "cid", "left").select("cid", "lo", F.coalesce("root", "cid").alias("root"))
    least = lab.groupBy("root").agg(F.min("lo").alias("component_id"))
    return members, written(lab.join(least, "root").select("cid", "root", "component_id"), "labels")


def ngram_components(docs: DataFrame, n: int = 5, pct: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``."""
    members, lab = _labelled(docs, n, pct)
    full = members.where("size > 0").join(lab, "cid").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    none = members.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(none)


def _row_classes(n: int):
    """(doc_id, text hash, class or null) of every row."""

    def run(batches):
        for rb in batches:
            cids = [_class_of(s) if len(s) else None for _, s in _sets(iter([rb]), n)]
            cols = [rb.column(rb.schema.get_field_index(c)) for c in ("doc_id", "th")]
            cid = column(np.array([c or 0 for c in cids], dtype=np.int64), np.array([c is not None for c in cids], dtype=bool))
            yield pa.RecordBatch.from_arrays([*cols, cid], names=["doc_id", "th", "cid"])

    return run


def keep_one(docs: DataFrame, n: int = 5, pct: int = 80) -> DataFrame:
    """The rows that stay when one row of each component is kept: the one of the smallest ``doc_id``
    (null last), then of the smallest text hash; of rows alike in both, any one.

    Rows without words stay.
    """
    _, lab = _labelled(docs, n, pct)
    id_, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    th = F.xxhash64(F.coalesce(text, F.lit("")))
    rows = docs.select(id_.alias("doc_id"), th.alias("th"), text.alias("text")).mapInArrow(_row_classes(n), "doc_id long, th long, cid long")
    rows = rows.where("cid IS NOT NULL").groupBy("doc_id", "th", "cid").agg(F.count(F.lit(1)).alias("m"))
    rows = written(rows.join(lab.select("cid", "root"), "cid").select("doc_id", "th", "root", "m"), "rows", SMALL_BATCH_BYTES)
    best = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")).alias("k"))
    rows = rows.join(best, "root").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col("th") == F.col("k.th")))
    odd = written(rows.where("NOT kept OR m > 1").select(F.col("doc_id").alias("_llm_id"), F.col("th").alias("_llm_th"), "kept"), "odd")
    some = lambda kept: maybe_broadcast(odd.where("kept" if kept else "NOT kept"), 24)
    on = id_.eqNullSafe(F.col("_llm_id")) & (F.col("_llm_key") == F.col("_llm_th"))
    left = docs.withColumn("_llm_key", th).join(some(False), on, "left_anti")
    again = some(True)
    alike = left.join(again, on, "left_semi").dropDuplicates(["doc_id", "_llm_key"])
    return left.join(again, on, "left_anti").union(alike).drop("_llm_key")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w) u
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), e AS (
  SELECT x AS a, y AS b FROM l UNION ALL SELECT y, x FROM l
), reach(a, b) AS (
  SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a
), low AS (
  SELECT a AS doc_id, least(a, min(b)) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component_id, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN low ON low.doc_id = d.doc_id
"""
