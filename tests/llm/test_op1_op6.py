"""Repeated spans and benchmark contamination against brute force and planted cases."""

import random

import numpy as np
import pytest

from cinerank.llm import op1_substring as op1
from cinerank.llm import op6_decontam as op6
from cinerank.llm.components import components


def prose(rng, n):
    return [f"{rng.choice('bcdfglmnprst')}{rng.choice('aeiou')}{rng.choice('bcdfglmnprst')}{rng.randrange(400)}x" for _ in range(n)]


def test_passages_are_found_wherever_they_stand_and_clean_texts_are_not(make):
    rng = random.Random(2)
    shared = [prose(rng, n) for n in (51, 60, 90)]
    rows, planted = [], set()
    for i in range(90):
        w = prose(rng, rng.randrange(60, 300))
        if i < 30:
            p = list(shared[i % 3])
            at = rng.randrange(len(w))
            w = w[:at] + p + w[at:]
            planted.add(i)
        rows.append((i, " ".join(w)))
    out = op1.repeated_spans(make(rows)).collect()
    assert {r.doc_id for r in out} == planted
    assert all(r.cluster_docs == 10 and r.n_words >= 25 for r in out)
    # a copy of each passage stays; one more where the first document's words hide an end paragraph
    assert 3 <= sum(not r.removed for r in out) <= 8


def test_edited_passages_join_by_minhash(make):
    rng = random.Random(4)
    base = prose(rng, 400)
    edited = list(base)
    for k in (50, 180, 333):
        edited[k] = "changed"
    out = op1.repeated_spans(make([(1, " ".join(base)), (2, " ".join(edited))])).collect()
    covered = {d: sum(r.n_words for r in out if r.doc_id == d) for d in (1, 2)}
    assert covered[1] > 330 and covered[2] > 330


def test_band_tuning_meets_the_recall():
    for pct, hashes, recall in ((80, 8, 0.95), (50, 32, 0.9), (90, 12, 0.99)):
        b, r = op1.tune_bands(pct, hashes, recall)
        assert b * r <= hashes and 1 - (1 - (pct / 100) ** r) ** b >= recall


def test_spans_edges(make):
    text = " ".join(prose(random.Random(1), 80))
    rows = [(None, None), (1, ""), (2, " \n"), (3, "one two"), (4, text), (None, text), (5, text), (5, text), (6, "w " * 50_000)]
    out = op1.repeated_spans(make(rows)).collect()
    # one word over and over has no paragraph end: it is a single paragraph
    assert {r.doc_id for r in out} == {4, None, 5}
    assert sorted(str(r.doc_id) for r in out if not r.removed) == ["None"]
    assert op1.repeated_spans(make([])).count() == 0
    with pytest.raises(ValueError):
        op1.repeated_spans(make([]), pct=0)


def test_paragraphs_do_not_depend_on_the_batch(make):
    rng = random.Random(9)
    df = make([(i, " ".join(prose(rng, 40) * (1 + i % 2))) for i in range(200)])
    a, b = (sorted(map(str, op1.repeated_spans(x, min_words=10).collect())) for x in (df.coalesce(1), df.repartition(7)))
    assert a == b and a


def test_an_old_passage_is_removed_next_to_one_that_opens_here(make):
    rng = random.Random(5)
    old, new = prose(rng, 120), prose(rng, 120)
    own = [prose(rng, 80) for _ in range(3)]
    texts = [own[0] + old, own[1] + old + new, new + own[2]]
    out = op1.repeated_spans(make([(i, " ".join(t)) for i, t in enumerate(texts)])).collect()
    got = sorted((r.doc_id, r.removed) for r in out)
    assert got == [(0, False), (1, False), (1, True), (2, True)]
    gone = next(r for r in out if r.doc_id == 1 and r.removed)
    assert 80 <= gone.first_word and gone.first_word + gone.n_words <= 200 and gone.n_words > 60


def test_every_verbatim_passage_of_51_words_is_reported(make):
    rng = random.Random(6)
    rows = []
    for g in range(150):
        passage = prose(rng, 51)
        for k in range(2):
            rows.append((2 * g + k, " ".join(prose(rng, rng.randrange(80)) + passage + prose(rng, rng.randrange(80)))))
    out = op1.repeated_spans(make(rows)).collect()
    assert {(r.doc_id, r.removed) for r in out} == {(i, i % 2 == 1) for i in range(300)}
    # an end paragraph with a word or two around the passage may still be similar enough
    assert all(25 <= r.n_words <= 60 and r.cluster_docs == 2 for r in out)


def one_paragraph(words, reach):
    """A text of these words that is a single paragraph, found by trying other first words."""
    rng = random.Random(len(words))
    while True:
        buf = np.frombuffer(" ".join(words).encode(), np.uint8)
        if len(op1._Cut(buf, np.array([0, len(buf)]), reach).first) == 1:
            return words
        words = prose(rng, 2) + words[2:]


def test_pairs_that_share_a_band_link_whatever_its_smallest_paragraph_is(make):
    rng = random.Random(3)
    rows, close = [], set()
    for g in range(12):
        base = one_paragraph(prose(rng, 30), 50)
        last = base[:-1]
        while len(last) < 30 or one_paragraph(last, 50) != last:  # 25 of 27 shingles
            last = base[:-1] + prose(rng, 1)
        rows += [(100 * g, " ".join(base)), (100 * g + 1, " ".join(last))]
        close |= {100 * g, 100 * g + 1}
        for k in range(40):  # 16 of 36 with the first
            w = list(base)
            while w == base or one_paragraph(w, 50) != w:
                w[6 + k % 6], w[16 + k % 6] = prose(rng, 2)
            rows.append((100 * g + 2 + k, " ".join(w)))
    out = op1.repeated_spans(make(rows), min_words=1, reach=50).collect()
    assert {r.doc_id for r in out} == close


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, k) for k in range(501, 560)] + [(9, 9), (None, 4), (700, 701), (701, 700)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [2, 60, 101]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- decontamination ---------------------------------------------------------


def items(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], "item_id long, text string, doc_id string")


def brute_hits(docs, bench, n=8, share=0.5, enough=40, run=13):
    """Items matched word for word, or by slot-consistent windows, by plain token lists; slots are numbers, names
    inside sentences and units."""
    import re

    def toks(t):
        t = re.sub(r"(?<=[a-z,;] )([A-Z][a-z]+)", "\x03\\1", t or "")
        t = re.sub(r"([0-9]+(?:[.,:/][0-9]+)*)", "\x01\\1", t)
        t = re.sub(r"\b(km|kg|miles|pounds)\b", "\x02\\1", t)
        t = "".join(c for c in t if c not in op6.PUNCT).lower()
        return [x for x in re.split(op6.SPACE, t) if x]

    slot = lambda x: x[0] in "\x01\x02\x03"
    tmpl = lambda w: [x[0] if slot(x) else x for x in w]
    out = set()
    for i, bt in bench:
        b = toks(bt)
        bw = [tuple(tmpl(b)[k : k + n]) for k in range(len(b) - n + 1)]
        ok = [k for k, w in enumerate(bw) if sum(x not in "\x01\x02\x03" for x in w) >= 4]
        for d, dt in docs:
            w = toks(dt)
            if not ok:
                bare = lambda v: [x.lstrip("\x01\x02\x03") for x in v]
                if len(b) >= 4 and any(bare(w[p : p + len(b)]) == bare(b) for p in range(len(w) - len(b) + 1)):
                    out.add((d, i, 1, 1))
                continue
            shifts = {}
            dw = [tuple(tmpl(w)[k : k + n]) for k in range(len(w) - n + 1)]
            for p, x in enumerate(dw):
                for k in ok:
                    if bw[k] == x:
                        shifts.setdefault(p - k, set()).add(k)
            hit, best = set(), 0
            for s, ks in shifts.items():
                spots = [p for p in range(len(b)) if slot(b[p]) and any(k <= p < k + n for k in ks)]
                votes = {}
                for p in spots:
                    votes.setdefault(b[p], []).append(w[p + s])
                stands = {v: min(set(ds), key=lambda x: (-2 * ds.count(x) - (x == v), x)) for v, ds in votes.items()}
                wrong = [p for p in spots if stands[b[p]] != w[p + s]]
                ks = {k for k in ks if not any(k <= p < k + n for p in wrong)}
                hit |= ks
                plain = sorted(k for k in ks if b[k : k + n] == w[k + s : k + s + n])
                length = 0
                for j, k in enumerate(plain):
                    length = length + 1 if j and k == plain[j - 1] + 1 else 1
                    best = max(best, length)
            if len(hit) >= share * len(ok) or len(hit) >= enough or best >= run - n + 1:
                out.add((d, i, len(ok), len(hit)))
    return out


def test_contamination_equals_brute_force(spark, make):
    rng = random.Random(8)
    vocab = ["red", "green", "tree", "apples", "walks", "toward", "box", "holds", "sum", "of", "the", "and", "river", "seven"]
    names, units = ["Anna", "Tomas", "Berta"], ["km", "kg", "miles", "pounds"]

    def word():
        x = rng.random()
        return str(rng.randrange(5)) if x < 0.12 else rng.choice(names) if x < 0.17 else rng.choice(units) if x < 0.2 else rng.choice(vocab)

    def sent(n):
        w = ["the", *(word() for _ in range(n))]
        return " ".join(x if not (x in names and p[-1].isdigit()) else "and" for p, x in zip(w, w[1:]))

    bench = [(i, sent(rng.randrange(3, 60))) for i in range(20)] + [(50, None), (51, ""), (52, "1 2 3 4 5 6 7 8 9"), (53, "a short question"), (54, "where does the river end")]
    docs = []
    for i in range(90):
        t = sent(rng.randrange(1, 120))
        if i % 3:
            b = rng.choice(bench[:20] + bench[-3:])[1].split()
            cut = b[: rng.randrange(len(b) // 3, len(b) + 1)]
            if i % 4:  # another value for each slot, consistently or not
                new = {str(k): str(10 + k) for k in range(5)} | {"Anna": "Maria", "Tomas": "Ivan", "km": "miles"}
                cut = [new.get(x, x) if i % 5 else (rng.choice([x, new[x]]) if x in new else x) for x in cut]
            t = f"{t} and {' '.join(cut)}, {sent(20)}"
        docs.append((i, t))
    got = {(r.doc_id, r.item_id, r.n_windows, r.n_matched) for r in op6.contaminated(make(docs), items(spark, bench)).collect()}
    assert got == brute_hits(docs, bench)
    assert len(got) > 25 and any(r[2] == r[3] == 1 for r in got)


def test_short_items_excerpts_and_one_changed_slot(spark, make):
    short = "which river is the longest in europe"  # seven words
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(67)]
    item = " ".join(words)
    twice = "the old mill sells 3 bags of white flour to the baker and the young baker sells 3 loaves of bread to the mill on every market day in the town"
    docs = [
        (1, "someone asked: Which river is the longest in Europe? nobody knew"),
        (2, "plain start " + " ".join(words[20:54]) + " plain end"),  # 34 of 67 words
        (3, "so " + twice.replace("sells 3 loaves", "sells 8 loaves") + " it is said"),
        (4, "which river is the widest in europe and which " + " ".join(words[:11])),
    ]
    got = {(r.doc_id, r.item_id) for r in op6.contaminated(make(docs), items(spark, [(1, short), (2, item), (3, twice)])).collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}


def test_variants_slots_names_and_units(spark, make):
    q = "If Anna buys 3 apples and Anna gives 3 apples to her friend Tom after 5 km of walking, how many remain?"
    bench = [(1, q)]
    docs = [
        (1, "intro words here " + q + " and more"),
        (2, q.replace("Anna", "Maria").replace("3", "7").replace("5 km", "9 miles").replace("Tom", "Paul")),
        (3, q.replace("Anna gives 3", "Anna gives 8").replace("friend", "good old friend")),  # one 3 became 8: windows over it do not count
        (4, "Nothing of the kind stands here, only 3 apples and some plain words about walking."),
        (5, None),
        (None, q),
    ]
    r = {x.doc_id: x for x in op6.contaminated(make(docs), items(spark, bench)).collect()}
    assert {1, 2, None} <= set(r) and 4 not in r and 5 not in r and 3 not in r
    assert r[1].verbatim and not r[2].verbatim
    left = op6.keep_clean(make(docs), items(spark, bench))
    assert sorted(str(x.doc_id) for x in left.collect()) == ["3", "4", "5"] and left.columns == make(docs).columns


def test_opening_names_and_signed_numbers_are_slots(spark, make):
    name = "Anna buys red apples at the market. Anna sells green pears near the river. Anna walks home with an old box. Anna counts all of the fruit again."
    cash = "A box costs $5 in the shop and $7 at the fair, so x=3 of them with a fee of -$2 come to how much money in all for the buyer."
    docs = [
        (1, "Plain words stand here. " + name.replace("Anna", "Maria")),
        (2, "plain words stand here " + cash.replace("$5", "\u20ac8").replace("$7", "$11").replace("x=3", "x=9").replace("-$2", "-$4")),
        (3, "The box is here. If all of the apples are sold, nobody counts the fruit near the old river."),
    ]
    got = {(r.doc_id, r.item_id): r for r in op6.contaminated(make(docs), items(spark, [(1, name), (2, cash)])).collect()}
    assert set(got) == {(1, 1), (2, 2)} and all(r.share == 1 and not r.verbatim for r in got.values())


def test_rolling_windows_equal_direct_hashes(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(list("abcdefghijklm"),), (list("abc"),), ([],)], "t array<string>")
    for n in (1, 2, 3, 5, 7, 8, 11):
        rows = df.select("t", op6.windows(F.col("t"), n).alias("w")).collect()
        for r in rows:
            assert len(r.w) == max(0, len(r.t) - n + 1) and len(set(r.w)) == len(r.w)


def test_contamination_empty_tables(spark, make):
    assert op6.contaminated(make([]), items(spark, [(1, "a b c d e f g h i")])).count() == 0
    assert op6.contaminated(make([(1, "a b c d e f g h i")]), items(spark, [])).count() == 0
