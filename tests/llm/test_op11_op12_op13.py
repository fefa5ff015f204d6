"""Whitening, hard negatives and token files against plain Python, and their edge cases."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import op11_whitening as op11
from cinerank.llm import op12_negatives as op12
from cinerank.llm import op13_tokens as op13

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
VEC_SCHEMA = "vec_id long, embedding array<float>, label int, id long, x string, h1 string, n long, w int, tag string, block int"


@pytest.fixture(scope="module")
def vectors(spark):
    """Embeddings from (vec_id, embedding[, label]) rows, with extra columns whose names clash with internal ones."""

    def build(rows):
        full = [(r[0], None if r[1] is None else [None if c is None else float(c) for c in r[1]], r[2] if len(r) > 2 else 0, -1, "x", "y", 5, 6, "t", 0) for r in rows]
        return spark.createDataFrame(full, VEC_SCHEMA)

    return build


def usable(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def quantised(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


# --- op11 ---------------------------------------------------------------------


def awkward_vectors(n, d, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d))
    rows = [(i, (rng.normal(size=d) @ mix * 0.1).tolist(), i % 3) for i in range(n)]
    rows += [(1000 + i, rows[3][1], 1) for i in range(n // 2)]  # a third of all rows are copies
    return rows + [(2000, None, 1), (2001, [float("nan")] + [0.0] * (d - 1), 1), (2002, [None] + [0.0] * (d - 1), 1), (2003, [float("inf")] * d, 1), (None, rows[0][1], 1), (3, rows[3][1], 0)]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(vectors, weights):
    rows = awkward_vectors(120, 6, 5)
    out = op11.whiten(vectors(rows), weights=weights).collect()
    good = [(r[0], quantised(r[1])) for r in rows if usable(r[1])]
    distinct = sorted({tuple(x) for _, x in good})
    w = np.array([1 if weights == "one" else sum(tuple(x) == t for _, x in good) for t in distinct])
    x = np.array(distinct)
    n, s = int(w.sum()), (x * w[:, None]).sum(axis=0)
    c = x - s / n
    e, u = np.linalg.eigh((c * w[:, None]).T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    assert len(out) == 4 * len(good)
    assert {r.n for r in out} == {n}
    assert {r.identity_error for r in out} == {max(r.identity_error for r in out)} and out[0].identity_error < 1e-9
    want = sorted((str(i), int(((n * np.array(v, dtype=object) - s.astype(object)) ** 2).sum())) for i, v in good)
    for k in range(4):
        mine = [r for r in out if r.component == k + 1]
        assert sorted((str(r.vec_id), r.deviation) for r in mine) == want
        assert all(abs(r.explained - e[k] / e.sum()) < 1e-9 for r in mine)
        z = {i: (np.array(v) - s / n) @ u[:, k] / math.sqrt(e[k]) for i, v in good}
        sign = np.sign(sum(r.whitened * z[r.vec_id] for r in mine))
        assert all(abs(r.whitened - sign * z[r.vec_id]) < 1e-8 for r in mine)


def test_whitening_joins_a_hot_vector_by_broadcast(vectors, monkeypatch):
    rows = awkward_vectors(60, 4, 6)
    key = lambda r: (str(r.vec_id), r.component, r.deviation, round(abs(r.whitened), 9))
    a = sorted(map(key, op11.whiten(vectors(rows)).collect()))
    monkeypatch.setattr(op11, "HOT", 1)  # no vector is hot
    assert sorted(map(key, op11.whiten(vectors(rows)).collect())) == a


def test_whitening_degenerate_tables(vectors):
    assert op11.whiten(vectors([])).collect() == []
    assert op11.whiten(vectors([(1, None), (2, [None])])).collect() == []
    assert op11.whiten(vectors([(1, [0.5, 0.25])] * 3)).collect() == []  # one distinct vector
    line = op11.whiten(vectors([(i, [i, 2 * i]) for i in range(5)])).collect()  # one direction only
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12
    short = op11.whiten(vectors([(1, [1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [])])).collect()
    assert {r.n for r in short} == {3}  # [1] is [1, 0]; [] is [0, 0]
    with pytest.raises(ValueError):
        op11.whiten(vectors([]), weights="two")


def test_whitening_exact_integers_beyond_double():
    x = np.array([[1 << 50, -3], [5, (1 << 50) + 1]])
    s = [int(v) for v in x.sum(axis=0)]
    assert op11.exact_sums(x << 11, np.array([3, 3])) == [3 * int(v) << 11 for v in s]
    assert op11.deviations(x, 2, s) == [None, None]
    assert op11.deviations(x >> 22, 2, [int(v) for v in (x >> 22).sum(axis=0)]) == [sum((2 * int(v) - int(t)) ** 2 for v, t in zip(r, (x >> 22).sum(axis=0))) for r in x >> 22]


# --- op12 ---------------------------------------------------------------------


def brute_negatives(rows, every, positives=5, negatives=3):
    rows = sorted({(i, lab, tuple(quantised(v))) for i, v, lab in rows if i is not None and lab is not None and usable(v)})
    dot = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for i, lab, v in rows:
        if i % every:
            continue
        scored = sorted((-dot(v, w), j, m) for j, m, w in rows if j != i)
        for p, j in [(-s, j) for s, j, m in scored if m == lab][:positives]:
            found = [(-s, k) for s, k, m in scored if m != lab and 50 * p <= 100 * -s <= 95 * p][:negatives]
            out += [(i, j, r + 1, k, p, s) for r, (s, k) in enumerate(found)]
    return sorted(out)


def hard_rows(seed, n=300):
    rng = random.Random(seed)
    rows = [(i - 20, [rng.gauss(0, 0.2) + (i % 4 == k) * 0.3 for k in range(5)], i % 4) for i in range(n)]
    rows += [(1000 + i, rows[40][1], i % 2) for i in range(n // 2)]  # many ties, over both labels
    rows += [(2000 + i, [0.0] * 5, i % 3) for i in range(60)]  # scores of 0
    rows += [(3000, [1.0, 1.0], 1), (3001, [], 2), (None, [0.1] * 5, 1), (3002, [0.1] * 5, None), (3003, None, 1), (3004, [None] * 5, 1), (3005, [float("nan")] * 5, 1)]
    return rows + rows[:50] + [(0, [0.4] * 5, 3)]  # repeated rows, and an id with a second row


def test_negatives_equal_brute_force(vectors):
    rows = hard_rows(3)
    got = op12.mine(vectors(rows), F.col("id") % 20 == 0, chunk_rows=7, block_rows=50).collect()
    assert sorted(map(tuple, got)) == brute_negatives(rows, 20)
    assert len(got) > 200


def test_negatives_edge_cases(vectors):
    assert op12.mine(vectors([]), F.col("id") % 20 == 0).collect() == []
    assert op12.mine(vectors([(1, [1.0], 1)]), F.col("id") % 20 == 0).collect() == []
    assert op12.mine(vectors([(0, [1.0], 1), (1, [1.0], 1)]), F.col("id") % 20 == 0).collect() == []
    with pytest.raises(ValueError):
        op12.mine(vectors([]), F.lit(True), high=100)


def test_negative_keys_and_exact_scores():
    a = np.array([-5, 0, 7], dtype=np.int64)
    s = np.array([3, -(1 << 63), (1 << 63) - 1], dtype=np.int64)
    keys = [k.tobytes() for k in op12.pack(a, -a, s, 1, a * 2)]
    assert [op12.unpack(k) for k in keys] == [(int(x), -int(x), int(y), 1, 2 * int(x)) for x, y in zip(a, s)]
    order = [(1, 0, 9, 0, 3), (1, 0, 9, 0, 4), (1, 0, 9, 1, -8), (1, 0, -2, 0, 0), (2, -1, 5, 0, 0)]
    packed = [op12.pack(*(np.array([v]) for v in (x[0], x[1], x[2])), x[3], np.array([x[4]]))[0].tobytes() for x in order]
    assert packed == sorted(packed)
    x = np.array([[1 << 40, 3], [-(1 << 40), 1]])
    assert op12.scores(x, x).tolist() == [[(1 << 63) - 1, -(1 << 63)], [-(1 << 63), (1 << 63) - 1]]
    assert op12.scores(np.array([[1 << 30, 1]]), np.array([[1 << 30, 1]])).tolist() == [[(1 << 60) + 1]]


# --- op13 ---------------------------------------------------------------------

ODD = ["", " ", "a  b\tc d e\u0085f\x0bg\x1ch\r\n", "<|endoftext|> x<|startoftext|>y <|endoftext|>", "ΑΣ ΣΑΣ ΟΔΥΣΣΕΥΣ", "é ́e ä ä​b",
       "I'm don't 'S 's ' s we'd.", "한국어 한 日本", "İstanbul ẞ ﻿ x", "ÀÉÎ.́ a.! É,. x× ÷y ÿŸ ﬁ IJ a.b,", "1234 ½ ²³ _-_ ...!!", "\x00 \x01a b", "End. end END, \"!\" ª º µm"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def test_words_encode_like_whole_texts(tokenizer):
    import pyarrow as pa

    enc = op13.Encoder(TOKENIZER, True)
    rng = random.Random(1)
    alphabet = "abcÀéß.,;!?'’ \t\n0½ ́한<|> Σ"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    ids, n = enc(pa.array(texts))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("seed", range(4))
def test_grammar_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    words = [rng.integers(0, 50, rng.integers(1, 9)) for _ in range(30)]
    docs = [np.concatenate([words[k] for k in rng.zipf(1.5, rng.integers(1, 40)) % 30] + [[1]]) for _ in range(200)] + [np.array([1]), np.full(500, 7)]
    ids, n = np.concatenate(docs), np.array([len(d) for d in docs])
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(n) - 1] = True
    symbols, rules = op13.repair(ids, last, 60)
    sizes = op13.rule_lengths(rules, 60)
    assert len(symbols) + 2 * len(rules) < 0.6 * len(ids)
    assert op13.expand(symbols, rules, 60).tolist() == ids.tolist()
    assert [len(op13.expand(np.array([60 + i]), rules, 60)) for i in range(len(rules))] == sizes.tolist()
    shard = op13.Shard({"base": 60, "rules": rules.tobytes(), "rule_lengths": sizes.astype("<u4").tobytes(), "symbols": symbols.tobytes()})
    assert shard.ids().tolist() == ids.tolist()
    ends = np.cumsum([sizes[s - 60] if s >= 60 else 1 for s in symbols.tolist()])
    assert set(np.cumsum(n)) <= set(ends)  # no symbol reaches over the end of a document
    for _ in range(30):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2).tolist())
        assert shard.run(a, b).tolist() == ids[a:b].tolist()


def test_token_files_equal_plain_encoding(make, spark, tokenizer, tmp_path):
    rng = random.Random(4)
    pool = ["lorem", "Ipsum,", "dolor.", "SIT", "amet!", "é", "x1"]
    rows = [(i * 3 % 101, " ".join(rng.choices(pool, k=rng.randrange(0, 80)))) for i in range(101)] + [(500 + i, t) for i, t in enumerate(ODD)]
    rows += [(-7, None), (900, "word " * 30_000), (901, "same text")] + [(901, "same text")] * 60 + [(None, "a"), (None, None), (902, "b"), (902, "c")]
    path = str(tmp_path / "tokens")
    op13.encode(make(rows).repartition(3), path, TOKENIZER, shard_tokens=500, part_bytes=20_000)
    got = sorted(op13.read_documents(spark, path).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    ids = lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    by_id = {}
    for d, t in rows:
        by_id.setdefault(d, []).append(ids(t))
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    at, stream = 0, []
    for r in got:
        mine = np.frombuffer(r.ids, dtype="<u4").tolist()
        assert mine in by_id[r.doc_id] and r.start == at and r.n_tokens == len(mine)
        by_id[r.doc_id].remove(mine)
        at += len(mine)
        stream += mine
    assert op13.shards(spark, path).count() > 5
    for a, n in [(0, 10), (700, 3000), (at - 5, 5), (0, at)]:
        pieces = sorted(op13.read_tokens(spark, path, a, n).collect())
        assert pieces[0].start == a
        assert [i for p in pieces for i in np.frombuffer(p.ids, dtype="<u4").tolist()] == stream[a : a + n]


def test_token_files_empty_table_and_parameters(make, spark, tmp_path):
    path = str(tmp_path / "none")
    op13.encode(make([]), path, TOKENIZER)
    assert op13.read_documents(spark, path).collect() == []
    assert op13.read_tokens(spark, path, 0, 5).collect() == []
    with pytest.raises(ValueError):
        op13.encode(make([]), path, TOKENIZER, shard_tokens=0)


def test_token_digest_query(spark, tokenizer):
    from cinerank.llm.common import table
    from cinerank.llm.queries import op13_token_ids

    sf = "/root/testdata/sf0.001"
    got = sorted(op13_token_ids(spark, sf).collect())
    at = 0
    for r, d in zip(got, table(spark, sf, "documents").orderBy("doc_id").collect(), strict=True):
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (d.doc_id, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)


@pytest.mark.parametrize("bits", [1, 3, 19])
def test_pairs_that_share_a_bucket_are_all_replaced(monkeypatch, bits):
    monkeypatch.setattr(op13, "BUCKET_BITS", bits)
    ids = np.tile(np.random.default_rng(4).integers(0, 50, 40), 60)
    last = np.zeros(len(ids), dtype=bool)
    last[39::40] = True
    symbols, rules = op13.repair(ids, last, 50)
    assert (op13.expand(symbols, rules, 50) == ids).all() and len(symbols) + 3 * len(rules) < len(ids) // 3


def test_stems_are_encoded_without_offsets(monkeypatch):
    enc = op13.Encoder(public_tokenizers.path("word_bpe_49k.json"), True)
    words = ["alpha", "betaworthy", "zürich", "ok"]

    class Fast:  # offers what needs no offsets only
        encode_batch_fast = staticmethod(enc.tok.encode_batch_fast)

    want = enc._each(words)
    enc.tok = Fast()
    monkeypatch.setattr(op13, "WORDS", 3)
    got = enc._stems(words)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_marks_behind_a_stem_make_no_new_word(monkeypatch, tokenizer):
    import pyarrow as pa

    enc, asked = op13.Encoder(TOKENIZER, True), []
    each = enc._each_of
    monkeypatch.setattr(enc, "_each_of", lambda pieces: asked.extend(pieces) or each(pieces))
    texts = ["alpha*** Betaworthy$% zürich_ ok. a' b's", "alpha### ok!? Éa<|"]
    ids, n = enc(pa.array(texts))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert [p for p in asked if any(c.isalpha() for c in p)] == ["b's"]


def test_all_marks_encode_like_whole_texts(tokenizer):
    import pyarrow as pa

    rng = random.Random(2)
    alphabet = "abSTlmÀß" + "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "    "
    texts = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(400)]
    texts += [f"wörd{a}{b}" for a in alphabet for b in "'_<|"] + ["don't It's we'LL a's* b'", "x<|endoftext|> y<|endoftext|>*"]
    ids, n = op13.Encoder(TOKENIZER, True)(pa.array(texts))
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_other_splitters_get_their_own_words(tmp_path):
    import pyarrow as pa
    from tokenizers import Tokenizer, pre_tokenizers

    tok, path = Tokenizer.from_file(TOKENIZER), str(tmp_path / "other.json")
    tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Whitespace(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    tok.save(path)
    texts = ["ab_ ab cd_* cd. ef?!", "Zürich_ zürich ab_"]
    ids, _ = op13.Encoder(path, True)(pa.array(texts))
    assert ids.tolist() == [i for e in tok.encode_batch(texts, add_special_tokens=False) for i in e.ids]


def test_rounds_at_the_last_threshold_look_at_few_places(monkeypatch):
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 40, 24) for _ in range(60)]
    ids = np.concatenate([np.concatenate([words[k], rng.integers(100, 20_000, 60)]) for k in rng.integers(0, 60, 900)])
    last = np.zeros(len(ids), dtype=bool)
    last[83::84] = True
    looked, bucket = [], op13._bucket
    monkeypatch.setattr(op13, "_bucket", lambda a, b: looked.append(len(a)) or bucket(a, b))
    symbols, rules = op13.repair(ids, last, 20_000)
    assert (op13.expand(symbols, rules, 20_000) == ids).all()
    whole = [n for n in looked if n > len(symbols) * 0.9]
    # one whole count for each threshold (the first at most the most frequent pair) and no more
    assert len(whole) <= 8 and len(looked) > 2 * len(whole) + 2
